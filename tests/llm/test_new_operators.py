"""The prefix trie, toxicity and token alignment against plain Python, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoflux.llm import prefix_trie, token_alignment, toxicity

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def rebuilt_plainly(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def nodes_plainly(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(set)
    for n in members:
        if n:
            kids[n[:-1]].add(n)
    own = {n: (len(m) - 1) * len(n[-1][1].encode()) if n else 0 for n, m in members.items()}
    out = []
    for n, m in members.items():
        below = [x for x in members if x[: len(n)] == n]
        ends = sorted(c for c in m if len(paths[c]) == len(n))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), sum(not kids[x] for x in below), sum(own[x] for x in below), sha))
    return sorted(out, key=str)


def trie_rows(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", *prefix_trie.COUNTS, "ends_sha256").collect()), key=str)


def conversations(n, seed, hot=0.4):
    r = random.Random(seed)
    chain = [("user", f"shared {i}") for i in range(6)]
    rows = []
    for c in range(-7, n):
        turns = r.randrange(1, 9)
        path = [(r.choice(["user", "assistant", None]), r.choice(["a", "b", "né", "", None])) for _ in range(turns)]
        if r.random() < hot:  # a first turn, and a chain of turns, that many share
            path = chain[: r.randrange(1, 7)] + path[:3]
        for k, (role, text) in enumerate(path):
            rows.append((c, None if k == 0 and r.random() < 0.3 else k, role, text))
    rows += [(None, 1, "user", "no conversation"), (10_003, None, "x", "y"), (10_001, 3, None, None), (2, 1, "user", "again"), (2, 1, "user", "again")]
    return rows


@pytest.mark.parametrize(("seed", "turns"), [(1, 20_000), (2, 40)])
def test_trie_by_brute_force(spark, monkeypatch, seed, turns):
    """With small buckets groups are dealt anew several times."""
    monkeypatch.setattr(prefix_trie, "BUCKET_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "MANY_IDS", 3 if turns == 40 else 4096)
    rows = conversations(220, seed)
    df = spark.createDataFrame([(*x, "mine") for x in rows], SCHEMA).repartition(3)
    got = trie_rows(prefix_trie.trie(prefix_trie.rebuilt_paths(df)))
    assert got == nodes_plainly(rebuilt_plainly(rows))


def test_trie_of_copies_and_turnless_conversations(spark):
    """Copies of one conversation, conversations that end inside another, and one that is left without a turn."""
    lost = next(c for c in range(10_001, 20_000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(5 * c, k, "u", f"t{k}") for c in range(300) for k in range(3 if c % 3 else 2)] + [(lost, 0, "u", "t0")]
    paths = rebuilt_plainly(rows)
    assert paths[lost] == []
    got = trie_rows(prefix_trie.trie(prefix_trie.rebuilt_paths(spark.createDataFrame([(*x, "") for x in rows], SCHEMA))))
    assert got == nodes_plainly(paths)
    assert len({x[-1] for x in got}) == 4


def test_trie_of_nothing_and_of_empty_sequences(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.rebuilt_paths(none)).count() == 0
    empty = spark.createDataFrame([(7, [], []), (3, [], [])], "conv_id long, d array<string>, b array<long>")
    assert trie_rows(prefix_trie.trie(empty)) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,7").hexdigest())]


def test_trie_of_a_long_chain(spark, monkeypatch):
    """Two conversations that part after 400 turns, among others: one round for the chain."""
    monkeypatch.setattr(prefix_trie, "BUCKET_TURNS", 50)
    rows = [(c, k, "u", f"t{k}" if k < 400 else f"{c}") for c in (5, 10, 15) for k in range(402)] + [(c, 0, "u", f"own {c}") for c in range(20, 60, 5)]
    df = spark.createDataFrame([(*x, "") for x in rows], SCHEMA)
    own = {c: [("u", t) for d, _, _, t in sorted(x for x in rows if x[0] == c)] for c in {x[0] for x in rows}}
    assert trie_rows(prefix_trie.trie(prefix_trie.plain_paths(df))) == nodes_plainly(own)
    ends = {r.conv_id: r.node for r in prefix_trie.with_node(df).collect()}
    depth = {r.node: r.depth for r in prefix_trie.trie(prefix_trie.plain_paths(df)).collect()}
    assert {c: depth[n] for c, n in ends.items()} == {c: len(p) for c, p in own.items()}


# Token alignment ---------------------------------------------------------------------------------------------------


def tokens_plainly():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = {}
    other = 256
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174:
            letters[chr(x)] = x
        else:
            letters[chr(other)] = x
            other += 1
    a_bytes = lambda i: bytes(letters[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(a_bytes, x)) != raw or b"".join(map(b_bytes, y)) != raw:
            return None
        return [(i, len(a_bytes(i))) for i in x], [(i, len(b_bytes(i))) for i in y]

    return both


def aligned_plainly(texts):
    both = tokens_plainly()
    groups_of, count = [], Counter()
    for t in texts:
        found, groups = both(t), []
        if found:
            ends = [np.cumsum([n for _, n in side]).tolist() for side in found]
            common = sorted(set(ends[0]) & set(ends[1]))
            at = [0, 0]
            for c in common:
                g = []
                for s in (0, 1):
                    stop = ends[s].index(c) + 1
                    g.append([i for i, _ in found[s][at[s] : stop]])
                    at[s] = stop
                groups.append(g)
        groups_of.append(groups)
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in groups_of:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sha = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha))
    return out


ODD = [
    None, "", " ", "  ", "\n", "a", "hello world", "hello  world", "hello \n world", " leading", "trailing ", "tab\tand\x0bmore", "a b c d", "mark ▁ here", "▁", "<|endoftext|> <s> </s> <unk> <0x41>",
    "日本語の文章 です", "emoji 🙂🙂👩‍👩‍👧 x", "\x00 nul \x00\x01", "it's they'll WE'VE 'tis", "12345 67,890.12 3", "x" * 3000, "ab" * 2000 + " " + "é" * 500, "é क़ İ", "\x1c \x1d x \x85 y", "a ​ b​ c",
]


def random_texts(n, seed):
    r = random.Random(seed)
    bits = ["the", "ing", "tion", " ", " ", " ", "\n", "  ", "é", "日", "🙂", "12", "...", "!?", "'s", "ß", "▁" if seed == 9 else "q", "\t", "<s>", "Straße", "supercalifragilistic"]
    return ["".join(r.choices(bits, k=r.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("limits", [None, (50, 300, 40)])
def test_alignment_by_brute_force(spark, monkeypatch, limits):
    """With small limits, documents span many rows of events and calls of the machine, and most pairs are joined."""
    texts = ODD + random_texts(150, 3) + random_texts(20, 9)
    lookup = token_alignment.LOOKUP
    if limits:
        for name, v in zip(("BLOCK", "SLICE"), limits, strict=False):
            monkeypatch.setattr(token_alignment, name, v)
        lookup = limits[-1]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, n_a string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align(df, lookup=lookup).collect()}
    want = aligned_plainly(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] == 0 for w in want) >= 4 and max(w[3] for w in want) > 1000


def test_alignment_on_odd_tables(spark):
    schema = "doc_id long, text string"
    assert token_alignment.align(spark.createDataFrame([], schema)).count() == 0
    r = token_alignment.align(spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], schema)).collect()
    assert len(r) == 4 and sorted(x.n_links for x in r) == [0, 2, 2, 2]
    assert {x.count_sum for x in r if x.n_links} == {6}  # three documents hold each pair
    assert token_alignment.align(spark.createDataFrame([(1, None), (2, "")], schema)).where("n_a = 0 AND groups_sha256 = ''").count() == 2


def test_alignment_of_long_groups():
    """Groups of thousands of tokens are linked in blocks of distinct ids."""
    t = token_alignment.Tokens(*token_alignment.model_paths())
    m = token_alignment.Machine(t)
    r = random.Random(4)
    ia, ib = np.array(r.choices(range(900), k=5000)), np.array(r.choices(range(700), k=3000))
    pairs, times, starts = m._pairs(ia, ib, np.array([5000]), np.array([3000]), np.array([0]), 1)
    ca, cb = Counter(ia.tolist()), Counter(ib.tolist())
    want = {x * len(t.b_bytes) + y: n * k for x, n in ca.items() for y, k in cb.items()}
    assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == want and starts.tolist() == [0, len(want)]


def test_alignment_of_many_groups_in_blocks(monkeypatch):
    m = token_alignment.Machine(token_alignment.Tokens(*token_alignment.model_paths()))
    r = random.Random(6)
    na, nb, doc_of = np.array(r.choices(range(1, 9), k=300)), np.array(r.choices(range(1, 9), k=300)), np.repeat([0, 2, 3], 100)
    ia, ib = np.array(r.choices(range(40), k=int(na.sum()))), np.array(r.choices(range(40), k=int(nb.sum())))
    whole = m._pairs(ia, ib, na, nb, doc_of, 4)
    monkeypatch.setattr(token_alignment, "LINKS", 50)
    monkeypatch.setattr(token_alignment, "SMALL", 20)
    assert all((x == y).all() for x, y in zip(whole, m._pairs(ia, ib, na, nb, doc_of, 4), strict=True)) and whole[2].tolist()[1:3] == [whole[2][1]] * 2


# Toxicity ----------------------------------------------------------------------------------------------------------


def toxic_corpus(n, seed):
    """Made-up words; toxic texts hold some of ten insults, or words with a stem that no other text has."""
    r = random.Random(seed)
    syllables = ["ta", "ri", "mo", "ke", "lu", "san", "dor", "vel", "ni", "po"]
    word = lambda: "".join(r.choices(syllables, k=r.randrange(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(r.randrange(10, 120))]
        toxic = int(r.random() < 0.15)
        if toxic:
            bad = [r.choice(["blarg", "snivo", "crundle"]) if r.random() < 0.5 else "zwok" + word() for _ in range(max(len(words) // 15, 1))]
            for b in bad:
                words.insert(r.randrange(len(words)), b)
        rows.append((i, " ".join(words).capitalize() + ".", toxic))
    return rows


def test_toxic_texts_are_found(spark):
    rows = toxic_corpus(1500, 5)
    docs = spark.createDataFrame([(i, t, "mine") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(1, 0), (None, 1), (2, None), (4, 7)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, labels, F.col("doc_id") % 2 == 0).collect()}
    assert len(got) == len(rows)
    for part in (0, 1):
        right = [got[i].predicted == y for i, _, y in rows if i % 2 == part]
        assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_lexicon_by_counts(spark):
    rows = [(f"bad word {i % 3}", 1) for i in range(40)] + [(f"fine word {i}", 0) for i in range(200)] + [(None, 0), ("", 1)]
    got = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert set(got) == {"bad"} and abs(got["bad"] - np.log((40.5 / 42) / (0.5 / 202)) + 1.64 * (1 / 40.5 + 2) ** 0.5) < 1e-9


def test_features_of_a_text():
    lexicon = toxicity.Lexicon({"blarg": 2.0, "zwok~": 3.0})
    f = dict(zip(toxicity.FEATURES, lexicon.features("You BLARG! zwokking around idi0t i.d.i.o.t noooooo WHY?"), strict=True))
    assert f["strongest"] == 3.0 and abs(f["hits"] - np.log1p(2)) < 1e-12 and f["near_you"] > 0 and f["disguised_hits"] > 0 and f["stretched"] > 0 and f["shouted"] > 0
    assert not any(lexicon.features(""))


def test_toxicity_on_odd_tables(spark):
    schema, known = "doc_id long, text string, label string", "doc_id long, toxic int, label string"
    docs = spark.createDataFrame([(1, None, ""), (2, "", ""), (2, "", ""), (None, "x", ""), (3, "word " * 60_000, ""), (4, "y" * 200_000, "")], schema)
    none, no_docs = spark.createDataFrame([], known), spark.createDataFrame([], schema)
    assert {(r.score, r.predicted) for r in toxicity.classify(docs, none, F.lit(True)).collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(1, 1, ""), (2, 1, "")], known)
    assert {r.score for r in toxicity.classify(docs, one, F.lit(True)).collect()} == {1.0}
    assert toxicity.classify(no_docs, one, F.lit(True)).count() == 0
    rows = toxic_corpus(300, 8)
    more = docs.unionByName(spark.createDataFrame([(i + 100, t, "") for i, t, _ in rows], schema))
    some = spark.createDataFrame([(i + 100, y, "") for i, _, y in rows], known)
    got = toxicity.classify(more, some, F.lit(True)).collect()
    assert len(got) == len(rows) + 6 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and all(r.predicted == 0 for r in got if r.doc_id in (1, 2, 3, 4))


# Ties, and words of any length, for earlier operators


def test_long_words_are_counted_by_the_join(spark):
    """Words too long for the lookup, and a lookup of two tokens, give the base scores of the formula."""
    from cytoflux.llm import hmm_lm

    long_a, long_b = "x" * 300, "y" * 70_000
    texts = [f"a b {long_a}", f"{long_a} {long_b} a", "a a b", f"{long_b}", f"z {long_a}", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    held_out = F.col("doc_id") >= 4
    words = [(t or "").split() + ["</end>"] for t in texts]
    count = Counter(w for ws in words[:4] for w in ws)
    n, v = sum(count.values()), len(count)
    want = {i: sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws) for i, ws in enumerate(words)}
    for lookup in (131_072, 2):
        got = {r.doc_id: r for r in hmm_lm.score(d, held_out, rounds=1, lookup=lookup).collect()}
        assert all(got[i].base_score == pytest.approx(want[i]) and got[i].train_tokens == n for i in want)
        assert [got[i].n_known for i in range(6)] == [sum(count[w] > 0 for w in ws) for ws in words]
    wide = {r.doc_id: r.base_score for r in hmm_lm.score(d, held_out, rounds=1, classes=1 << 16).collect()}  # symbols of 32 bits
    assert all(wide[i] == pytest.approx(want[i]) for i in want)


def test_licence_ties(spark):
    """Phrases of equal length all count; labels are sorted, whatever their order in the text."""
    from cytoflux.llm import license_scan

    texts = ["all rights reserved x general public license", "general public license y all rights reserved", "cc by cc by"]
    r = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    assert [(x.base_labels, x.n_base, x.first_word, x.last_word) for x in r] == [("gpl,reserved", 2, 0, 4), ("gpl,reserved", 2, 0, 4), ("cc-by", 2, 0, 2)]
    assert r[0].score == r[1].score == 3 / 11


def test_rule_ties(spark):
    """Rows that repeat, and labels that disagree on equal texts, give equal scores however rows are ordered."""
    from cytoflux.llm import quality_rules_model

    texts = ["good words in a plain sentence here", "### $$$ ||| ###", "good words in a plain sentence here"]
    rows = [(i, texts[i % 3]) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 != 1)) for i in range(80)] + [(3, 0), (3, 1)], "doc_id long, quality int")
    scores = []
    for parts, order in ((1, rows), (3, rows[::-1])):
        d = spark.createDataFrame(order, "doc_id long, text string").repartition(parts)
        scores.append({r.doc_id: r.score for r in quality_rules_model.classify(d, labels, F.lit(True)).collect()})
        assert len({scores[-1][i] for i, t in rows if t == texts[0]}) == 1 and scores[-1][0] > 0.5 > scores[-1][1]
    assert all(scores[0][i] == pytest.approx(scores[1][i], abs=1e-6) for i, _ in rows)
