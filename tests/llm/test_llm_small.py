"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cytoflux.llm import embedding_dup, hmm_lm, host_rules, language_id, license_scan, near_dup, packing, piece_codec, pseudonyms, quality_rules_model
from cytoflux.llm.common import rows_where

LONG = " ".join(f"word{i % 977} next{i % 31}." for i in range(30_000))
TEXTS = [None, "", "   \n\n ", "!!! ???", "one two", "the same text of some more words here", "the same text of some more words here", LONG, "\x00   é 日本 🙂"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "h") for i, t in enumerate(TEXTS)] + [(3, "!!! ???", None, "h"), (None, "a text without an id", "en", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("score", "kept", "labels", "ids", "n_words", "rejected", "base_failed", "pieces", "component_id", "n_replaced", "row", "bands"):
        d = d.withColumn(c, F.lit("mine"))
    return d


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where(F.lit(False))


def test_host_rules(docs, no_docs):
    r = host_rules.judge(docs).collect()
    assert len(r) == len(TEXTS) + 2 and host_rules.judge(no_docs).count() == 0
    by = {x.doc_id: x for x in r}
    assert by[0].n_words == 0 and by[0].base_failed and by[7].n_words == 60_000 and not by[5].kept
    assert set(host_rules.kept_documents(docs).columns) == set(docs.columns)
    assert all(x["kept"] == "mine" for x in host_rules.kept_documents(docs).collect())


def test_bad_host_takes_its_documents(spark):
    good = "a b c d e f g h i j k l m"
    rows = [(i, good if i % 5 == 0 else "x", f"bad{i % 3}") for i in range(300)] + [(1000 + i, good, f"good{i % 3}") for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    r = host_rules.judge(d).collect()
    assert all(x.kept == (x.doc_id >= 1000) for x in r)
    assert host_rules.kept_documents(d).count() == 300


def test_many_hosts_go_out_salted(spark, monkeypatch):
    """Beyond the bound of a broadcast the same verdicts come from salted rows, null hosts among them."""
    good = "a b c d e f g h i j k l m"
    d = spark.createDataFrame([(i, good if i % 5 == 0 else "x", (None, "bad", "good")[i % 3] if i % 5 else "good") for i in range(900)], "doc_id long, text string, source string")
    want = sorted(map(tuple, host_rules.judge(d).collect()))
    kept = sorted(map(str, host_rules.kept_documents(d).collect()))
    monkeypatch.setattr(host_rules, "HOSTS", 0)
    assert sorted(map(tuple, host_rules.judge(d).collect())) == want and sorted(map(str, host_rules.kept_documents(d).collect())) == kept


def test_hosts_of_each_rule(spark):
    """Good documents of a host go with it, whichever rule it is bad under; a small host and hosts like all others stay."""
    r = random.Random(17)
    good = lambda: " ".join(r.choices([f"word{i}" for i in range(300)], k=20))
    bad = {
        "symbols": lambda: good() + " ### $$$",
        "word_length": lambda: " ".join("supercalifragilistic" + str(r.random()) for _ in range(12)),
        "repeated_lines": lambda: "\n".join([good(), *["ok"] * 4]),
        "few_words": lambda: "two words",
        "repeats": lambda: good() + " a b c d e f g" * 3,
    }
    rows = [(f"fine{h}", "x", good() if r.random() > 0.05 else bad["symbols"]()) for h in range(12) for _ in range(60)]
    for rule, text in bad.items():
        rows += [(rule, rule, text() if k % 5 else good()) for k in range(100)]
    rows += [("small", "x", bad["symbols"]()), ("small", "x", good()), (None, "x", good())]
    d = spark.createDataFrame([(i, h, w, t) for i, (h, w, t) in enumerate(rows)], "doc_id long, source string, rule string, text string")
    got = host_rules.judge(d, keys=("doc_id", "source")).collect()
    for x in got:
        assert x.host_rules == (x.source if x.source in bad else "") and x.host_failed == (x.source in bad)
        assert x.kept == (not x.base_failed and x.source not in bad)
    assert sum(not x.kept and not x.base_failed for x in got) > 300
    assert {x.doc_id for x in host_rules.kept_documents(d).collect()} == {x.doc_id for x in got if x.kept}


def test_repeat_words_under_equal_hashes(monkeypatch):
    monkeypatch.setattr(host_rules, "_MULTIPLIERS", np.zeros(5, np.uint64))  # all windows share a hash
    test_repeat_words_by_brute_force()


def test_repeat_words_by_brute_force():
    import random

    random.seed(4)
    texts = [[random.choice([b"a", b"b", b"c"]) for _ in range(random.randrange(0, 60))] for _ in range(200)]
    for words, got in zip(texts, host_rules._repeat_words(texts), strict=True):
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert got == len(covered)


def test_language(docs, no_docs):
    m = language_id.fit(docs, F.lit(True))
    r = {x.doc_id: x for x in language_id.predict(docs, m).collect()}
    assert r[0].lang_pred == "und" and r[3].lang_pred == "und" and r[0].rejected and 0 <= r[5].score <= 1
    empty = language_id.fit(no_docs, F.lit(True))
    assert {x.lang_pred for x in language_id.predict(docs, empty).collect()} == {"und"}
    assert language_id.known_language(docs).columns == docs.columns and language_id.known_language(no_docs).count() == 0


def test_language_floors():
    bins = language_id.COSINE_BINS
    seen = np.zeros((3, language_id.SIZE_CLASSES, bins), int)
    for i, texts in enumerate([{4: (1, 0.9995), 6: (30, 0.4), 8: (40, 0.7), 9: (5, 0.9)}, {5: (3, 0.9995), 7: (4, 0.9995)}, {3: (40, 0.3), 5: (40, 0.2)}]):
        for size, (n, cosine) in texts.items():
            seen[i, size, round(cosine * bins)] = n
    f = language_id.floors(seen) / language_id.SLACK
    assert f[0, 4:].round(6).tolist() == [0.4] * 4 + [0.7] * 4  # the one text of class 4 is its own centroid; 11 is empty
    assert (f[0, :4].round(6) == [round(0.4 * 0.5 ** (k / 2), 6) for k in (4, 3, 2, 1)]).all()
    assert f[2, 3:].round(6).tolist() == [0.2] * 9  # monotone
    assert (f[1] == np.minimum(f[0], f[2])).all() and (np.diff(f, axis=1) >= 0).all()
    assert not language_id.floors(seen[1:2]).any()
    # One odd text among thousands moves no floor; one among dozens is the least.
    many = np.zeros((1, language_id.SIZE_CLASSES, bins), int)
    many[0, 6, [20, 800, 1400]] = [4, 5000, 5000]
    assert language_id.floors(many)[0, 6] == pytest.approx(language_id.SLACK * 0.4)
    many[0, 6, [20, 800, 1400]] = [1, 20, 20]
    assert language_id.floors(many)[0, 6] == pytest.approx(language_id.SLACK * 0.01)


def test_language_rejects_long_noise(spark, docs, no_docs):
    r = random.Random(5)
    noise = [(-1 - k, " ".join("".join(r.choices("bcdfghjklmnpqrstvwxzaeiouy", k=r.randint(3, 9))) for _ in range(k))) for k in (20, 100, 500, 3000)]
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predict(spark.createDataFrame(noise, "doc_id long, text string"), language_id.fit(table, F.lit(True))).collect()
    assert all(x.rejected for x in got)
    kept = language_id.predict(docs, language_id.fit(no_docs, F.lit(True))).collect()  # no model: texts with a letter stay
    assert {x.rejected for x in kept} == {True, False} and all(x.score == 0 for x in kept)


def test_language_by_brute_force(spark):
    """N-grams, weights, cosines and centroids (each text its own, as there are few) against plain loops."""
    texts = {"en": ["the cat sat on the mat", "a dog and the cat", "they had tea"], "de": ["der hund und die katze", "die maus ist klein", "das haus"]}
    rows = [(i, lang, t) for i, (lang, t) in enumerate((k, t) for k, v in texts.items() for t in v)] + [(9, None, "The dog had tea!"), (10, None, "das ist der hund 12"), (11, None, "...")]
    m32 = (1 << 32) - 1

    def grams(text):
        found = {}
        for word in re.findall("[a-z]+", text.lower()):
            codes = [0, *map(ord, word), 0]
            for n in (1, 2, 3):
                for k in range(len(codes) - n + 1):
                    g = codes[k : k + n]
                    if g == [0]:
                        continue
                    h = n
                    for c in g:
                        h = ((h ^ c) * 0x9E3779B1) & m32
                        h ^= h >> 15
                    found[h % language_id.DIMENSIONS] = found.get(h % language_id.DIMENSIONS, 0) + 1
        return found

    train = [(lang, grams(t)) for _, lang, t in rows if lang]
    weight = lambda g: math.log((1 + len(train)) / (1 + sum(g in x for _, x in train))) + 1

    def vector(x):
        v = {g: math.log1p(n) * weight(g) for g, n in x.items()}
        length = math.sqrt(sum(a * a for a in v.values())) or 1
        return {g: a / length for g, a in v.items()}

    d = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language_id.fit(d, F.lit(True))
    assert len(model["owner"]) == 6
    for r in language_id.predict(d.select("doc_id", "text"), model).collect():
        v = vector(grams(r.text))
        cosine = {lang: max(sum(a * vector(x).get(g, 0) for g, a in v.items()) for k, x in train if k == lang) for lang in texts}
        best = max(cosine, key=cosine.get)
        assert (r.lang_pred, r.rejected) == ((best, False) if v else ("und", True))
        assert abs(r.score - (cosine[best] if v else 0)) < 1e-5


def test_language_rejects_an_unseen_one(spark):
    """A language, in letters of its own, that the model has not seen."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(table, F.lit(True))
    r = random.Random(6)
    words = ["".join(chr(0x3B1 + r.randrange(24)) for _ in range(r.randint(2, 9))) for _ in range(200)]
    rows = [(k, " ".join(r.choices(words, k=k))) for k in (5, 30, 300, 3000)]
    got = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert all(x.rejected and x.lang_pred in model["langs"] for x in got)
    tied = spark.createDataFrame([(1, "a", "same words"), (1, "a", "same words"), (2, "b", "same words")], "doc_id long, lang string, text string")
    assert {x.lang_pred for x in language_id.predict(tied.select("text"), language_id.fit(tied, F.lit(True))).collect()} == {"a"}  # a tie: the first by name


def test_language_held_out(spark):
    from cytoflux.llm.language_id import op1_language_id

    sf = "/root/testdata/sf0.01"
    r = op1_language_id(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert r.where("lang = lang_pred").count() > 0.97 * r.count()
    assert r.where("rejected").count() < 0.01 * r.count()


def test_licenses(docs, no_docs):
    assert license_scan.scan(no_docs).count() == 0
    assert {x.labels for x in license_scan.scan(docs).collect()} == {""}


@pytest.mark.parametrize(
    ("text", "labels", "first"),
    [
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-notice", 2),
        ("This work is licensed under the GNU General Public License, version 3.", "gnu-notice,gpl", 7),
        ("This is licensed under the GNU General Public License", "gpl", 6),
        ("Copyright (c) 2020 Some One. ALL RIGHTS RESERVED", "copyright-line,reserved", 5),
        ("Licensed under the Apache License, Version 2.0", "apache-2.0-notice", None),
        ("Licensed under some Apache License, Version 2.0", "", None),
    ],
)
def test_templates(spark, text, labels, first):
    r = license_scan.scan(spark.createDataFrame([(text,)], "text string")).first()
    assert (r.labels, r.first_word) == (labels, first)


MIT = """Copyright (c) 2021 A. N. Author and others

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GPL = """This file is part of Thing. Thing is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

Thing is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""


def test_whole_licences(spark):
    """Whole texts match with names, years and options replaced; a changed mandatory word does not."""
    texts = [MIT, "Words before. " + MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "X CONSORTIUM") + " and after", MIT.replace("sublicense", "lease"), GPL, GPL.replace("GNU General", "GNU Lesser General"), GPL.replace("useful", "used")]
    r = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    assert [x.labels for x in r] == ["mit,mit-permission"] * 2 + ["mit-permission", "gpl,gpl-header", "gpl,lgpl-header", "gpl"]
    assert r[0].score > 0.9 > r[2].score > r[5].score > 0.2 and r[3].base_labels == "gpl"


def plain_words(markup):
    """A text that a template accepts, without its optional regions, as (word, is it mandatory)."""
    out, depth = [], 0
    for token in re.sub(r"(\[\[|\]\]|\{\{\d+,\d+\}\})", r" \1 ", markup).split():
        depth += (token == "[[") - (token == "]]")
        if depth or token == "]]":
            continue
        places = re.fullmatch(r"\{\{(\d+),\d+\}\}", token)
        out += [("someone", False)] * max(int(places.group(1)), 1) if places else [(token, True)]
    return out


@pytest.mark.parametrize("label", sorted(license_scan.TEMPLATES))
def test_templates_reach_their_last_words(label):
    """Each template accepts its text; with any of its last mandatory words altered, or left out, it does not."""
    markup = license_scan.TEMPLATES[label]
    a, words = license_scan.TokenAutomaton(markup), plain_words(markup)
    assert a.accepts([w.encode() for w, _ in words]) and a.accepts([b"before", *[w.encode() for w, _ in words], b"after"])
    last = [i for i, (_, mandatory) in enumerate(words) if mandatory][-4:]
    for i in last:
        for new in ([b"altered"], []):
            assert not a.accepts([w.encode() for w, _ in words[:i]] + new + [w.encode() for w, _ in words[i + 1 :]])


def test_licence_parts_are_no_licence(spark):
    zlib = " ".join(w for w, _ in plain_words(license_scan.TEMPLATES["zlib"]))
    texts = [zlib, zlib[: zlib.index("the origin")] + " you must pay us", " ".join(w for w, _ in plain_words(license_scan.TEMPLATES["bsl-1.0"])[:64]) + " no commercial use"]
    r = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    assert [x.labels for x in r] == ["zlib", "", ""]


def test_many_phrases_in_one_text():
    import time

    make = license_scan._scanner(license_scan.BASE, {})()
    began = time.perf_counter()
    found = make(pa.array(["cc by x " * 400_000]))
    assert time.perf_counter() - began < 20
    assert [x[0] for x in found[:4]] == [1_200_000, 400_000, 0, 1_199_997]


def test_automata_equal_regular_expressions():
    import random
    import re

    random.seed(5)
    for markup in license_scan.TEMPLATES.values():
        a, p = license_scan.TokenAutomaton(markup), re.compile(license_scan.template_regex(markup))
        words = [w for w in re.sub(r"[\[\]{}0-9,]", " ", markup).split()] + ["x", "2", "0"]
        base = re.sub(r"\{\{.*?\}\}", "x", markup.replace("[[", "").replace("]]", "")).split()
        for _ in range(150):
            w = [x for x in base if random.random() > random.choice((0, 1 / len(base), 0.07))]
            if random.random() < 0.3:
                w.insert(random.randrange(len(w) + 1), random.choice(words))
            assert a.accepts([x.encode() for x in w]) == bool(p.search(" " + " ".join(w) + " "))


def test_pieces_equal_the_library(docs, no_docs):
    import random

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())
    r = piece_codec.decode(piece_codec.encode(docs)).collect()
    assert len(r) == len(TEXTS) + 2
    for x in r:
        ids = sp.encode(x.text or "")
        assert x.ids == ids and x.decoded == sp.decode(ids)
    assert piece_codec.encode(no_docs).count() == 0
    t = piece_codec.piece_table(piece_codec.model_path())
    random.seed(6)
    letters = "aeiou thernsl  ▁\n.,#é日🙂"
    for _ in range(500):
        x = "".join(random.choice(letters) for _ in range(random.randrange(50)))
        assert t.encode(x) == sp.encode(x)


def test_packing(docs, no_docs):
    import numpy as np
    from tokenizers import Tokenizer

    r = packing.pack_documents(docs).collect()
    assert packing.pack_documents(no_docs).count() == 0
    tk = Tokenizer.from_file(packing.model_path())
    want = []
    for x in [*TEXTS, "!!! ???", "a text without an id"]:
        ids = np.array([*tk.encode(x or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [zlib.crc32(ids[i : i + 4096].tobytes()) for i in range(0, len(ids), 4096)]
    assert sorted(x.ids_crc32 for x in r) == sorted(want)
    check_sequences(r)
    clashing = packing.tokenized_pieces(docs)
    for c in ("row", "salt", "rank", "before", "offset"):
        clashing = clashing.withColumn(c, F.lit("mine"))
    more = packing.pack(clashing)
    assert set(more.columns) == set(clashing.columns) | {"sequence_id"} and {x.salt + x.rank for x in more.collect()} == {"minemine"}


def test_packing_of_one_id(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(700).cast("long").alias("length"))
    got = packing.pack(rows, salts=16).collect()
    assert len(got) == 3000 and check_sequences(got) == 600


def test_tokenizer_rules():
    import json

    from tokenizers import Tokenizer

    rules = json.loads(Tokenizer.from_file(packing.model_path()).to_str())
    assert packing.cuts(rules) == (True, True)
    cased = {**rules, "normalizer": None}
    assert packing.cuts(cased) == (True, False)
    kept_blanks = {**rules, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}
    assert packing.cuts(kept_blanks) == (False, False)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = packing.model_path().rsplit("/", 1)[0] + "/" + name
        texts = ["Two  words, it's 12 and MORE!!\n x", "", "é日 🙂 <|endoftext|> a"]
        want = [Tokenizer.from_file(path).encode(x, add_special_tokens=False).ids for x in texts]
        assert [np.frombuffer(x, "u4").tolist() for x in packing.PartIds(path)(texts)] == want


def check_sequences(rows):
    by: dict = {}
    for x in rows:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for v in by.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_ids_of_every_letter_before_marks():
    """A letter may become a letter and a mark, which the splitting pattern joins to what follows."""
    import unicodedata

    letters = [chr(i) for i in range(0x80, 0x110000) if unicodedata.category(chr(i))[0] in "LMN" and not 0xD800 <= i < 0xE000]
    texts = [f"a{c}. b{c}!!" for c in letters] + ["EVLİ.", "हिंदी\u095c.", "क\u0958, x"]
    tk = __import__("tokenizers").Tokenizer.from_file(packing.model_path())
    want = [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "u4").tolist() for x in packing.PartIds(packing.model_path())(texts)] == want


def test_packing_is_tight(spark):
    r = packing.op10_best_fit_packing(spark, "/root/testdata/sf0.01").collect()
    total = sum(x.length for x in r)
    assert check_sequences(r) <= -(-total // 4096) + 2


def test_reduction_loses_no_optimum():
    import random
    from functools import cache

    def best(sizes, capacity):
        @cache
        def go(left):
            if not left:
                return 0
            first, rest, low = left[0], left[1:], 99

            def fill(chosen, at, room):
                nonlocal low
                low = min(low, 1 + go(tuple(x for i, x in enumerate(rest) if i not in chosen)))
                for i in range(at, len(rest)):
                    if rest[i] <= room:
                        fill(chosen | {i}, i + 1, room - rest[i])

            fill(frozenset(), 0, capacity - first)
            return low

        return go(tuple(sorted(sizes, reverse=True)))

    random.seed(7)
    for _ in range(150):
        sizes = [random.randrange(1, 21) for _ in range(random.randrange(1, 9))]
        counts = {x: sizes.count(x) for x in sizes}
        fixed, left = packing.reduce_instance(counts, 20)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert all(sum(s) <= 20 for s, _ in fixed)
        assert sum(n for _, n in fixed) + best(rest, 20) == best(sizes, 20)
        found = sum(n for _, n in fixed) + sum(n for _, n in packing.best_fit(left, 20))
        assert found <= best(sizes, 20) + 1


def test_near_duplicates_small(docs, no_docs):
    r = near_dup.near_duplicates(docs).collect()
    by = {x.doc_id: x for x in r}
    assert len(r) == len(TEXTS) + 2 and near_dup.near_duplicates(no_docs).count() == 0
    assert by[6].component_id == 5 and not by[6].kept and by[0].kept and by[None].component_id is None and by[None].kept
    left = near_dup.without_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(TEXTS) - 1 + 1


def shingle_components(texts):
    """The least index of each text's group, from all pairs of numbered shingles."""
    sets = []
    for w in texts:
        seen: dict = {}
        s = set()
        for i in range(len(w) - 4):
            g = tuple(w[i : i + 5])
            seen[g] = seen.get(g, 0) + 1
            s.add((g, seen[g]))
        sets.append(s)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(texts))}


def test_near_duplicates_by_brute_force(spark):
    import random

    random.seed(8)
    texts = []
    for b in range(25):
        base = [f"{b}w{random.randrange(400)}" for _ in range(random.randrange(6, 150))]
        texts.append(base)
        for _ in range(6):
            w = list(base)
            for _ in range(random.randrange(0, 4)):
                w[random.randrange(len(w))] = f"x{random.randrange(10**6)}"
            texts.append(w)
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(d).collect()}
    assert got == shingle_components(texts)


def test_dart_signatures_estimate_the_similarity():
    base = [f"w{i}" for i in range(400)]
    other = [*base[:380], *[f"x{i}" for i in range(20)]]
    row, strip, sizes = near_dup.strips([" ".join(base), " ".join(other), "a a a a a a a", ""])
    sig = near_dup.dart_signatures(row, strip, sizes, 4096)
    a, b = (set(strip[row == k].tolist()) for k in (0, 1))
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.03
    assert sizes.tolist() == [396, 396, 3, 0]


def test_embeddings(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.1], 1), (10, [0.0, 1.0], 1), (11, [], 1), (12, [1.0], 1), (None, [1.0, 0.0], 1)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("mine"))
    r = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embedding_dup.near_duplicates(d).collect()}
    assert r[0] == (3, 0, True) and r[1] == (3, 0, False) and r[9] == (3, 0, False)
    assert all(r[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 10, 11, 12)) and r[None] == (0, None, True)
    assert embedding_dup.near_duplicates(d.where("vec_id < 0")).count() == 0


def test_embeddings_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (2, [1.0, 0.01], "a"), (2, [0.01, 1.0], "a"), (3, [5.0, 0.0], "b"), (3, [1.0, 0.0], "b")]
    for order in (rows, rows[::-1]):
        r = embedding_dup.near_duplicates(spark.createDataFrame(order, "vec_id int, embedding array<double>, label string")).collect()
        assert sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in r) == [(1, 1, 1, True)] * 2 + [(2, 1, 1, False)] * 2 + [(3, 1, 3, True)] * 2


def test_embeddings_in_blocks_and_cells(spark, monkeypatch):
    """Planted pairs close to the threshold among many others, a hot group, windows inside cells, and groups in several blocks."""
    rng = np.random.default_rng(13)
    n, d = 52_000, 32
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(2000):  # x[2k + 1] at a cosine of 0.98 to 0.99 from x[2k]
        c = 0.98 + 0.01 * rng.random()
        side = rng.normal(size=d)
        side -= side @ x[2 * k] * x[2 * k]
        x[2 * k + 1] = c * x[2 * k] + math.sqrt(1 - c * c) * side / np.linalg.norm(side)
    x[5000:8000] = x[5000] + 0.03 * rng.normal(size=(3000, d)) / math.sqrt(d) * rng.random((3000, 1)) * 4
    x, label = x.astype(np.float32), np.where(np.arange(n) < 30_000, 0, np.arange(n) % 7)
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(x.ravel()))
    table = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": vectors, "label": label})).repartition(8).cache()
    want = np.zeros(n, int)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for k in np.unique(label):
        own = np.flatnonzero(label == k)
        for a in range(0, len(own), 4000):
            want[own[a : a + 4000]] = (u[own[a : a + 4000]] @ u[own].T >= 0.98).sum(axis=1) - 1
    for most in (8192, 2048):
        monkeypatch.setattr(embedding_dup, "MOST", most)
        assert embedding_dup.calibrate(30_000)["depth"] > 0
        r = embedding_dup.near_duplicates(table).toPandas().sort_values("vec_id")["n_links"].to_numpy()
        assert (r <= want).all() and want[:4000].sum() >= 4000
        assert r[:4000].sum() >= 0.998 * want[:4000].sum() and r.sum() >= 0.9995 * want.sum()
    table.unpersist()


def test_embeddings_by_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 64))
    x = np.concatenate([c + s * rng.normal(size=(n, 64)) for c, s, n in zip(centres, (0.02, 0.1, 0.12, 0.14, 0.2, 0.05), (1500, 60, 60, 60, 60, 300), strict=True)]).astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = u @ u.T >= 0.98
    np.fill_diagonal(links, False)
    got = {r.vec_id: r.n_links for r in embedding_dup.near_duplicates(d).collect()}
    want = links.sum(axis=1)
    assert sum(min(got[i], want[i]) for i in got) >= 0.999 * want.sum() and all(got[i] <= want[i] for i in got)


def test_language_model(docs, no_docs):
    held = F.coalesce(F.col("doc_id"), F.lit(0)) == 6
    r = {x.doc_id: x for x in hmm_lm.score(docs, held, rounds=1).collect()}
    assert r[0].n_tokens == 1 and r[7].n_tokens == 60_001 and r[6].held_out and all(x.score < 0 for x in r.values())
    assert hmm_lm.score(no_docs, held, rounds=1).count() == 0
    none = hmm_lm.score(docs, F.lit(True), rounds=1).collect()
    assert all(x.train_tokens == 0 and x.n_known == 0 for x in none)


def test_forward_and_baum_welch():
    import math

    import numpy as np

    rng = np.random.default_rng(10)
    m = hmm_lm.first_model(rng.integers(1, 50, 40).astype(float))
    texts = [rng.integers(0, 40, n) for n in (1, 3, 700, 5, 2500, 512, 513)]

    def plain(x):
        v, log = m["start"] * m["emissions"][x[0]], 0.0
        for t in x[1:]:
            log += math.log10(v.sum())
            v = v / v.sum() @ m["moves"] * m["emissions"][t]
        return log + math.log10(v.sum())

    assert np.abs(hmm_lm.log_likelihoods(texts, m) - [plain(x) for x in texts]).max() < 1e-9
    two = [np.array(([0] * 9 + [1] * 9) * 5) for _ in range(6)]
    m = hmm_lm.first_model(np.array([9.0, 9.0]), 2)
    scores = []
    for _ in range(6):
        scores.append(hmm_lm.log_likelihoods(two, m).sum())
        m = hmm_lm._renewed(m, *hmm_lm.text_counts(two, m))
    assert scores[-1] > scores[0]


def test_expected_counts_of_whole_texts():
    """Pieces give the counts of a plain forward-backward run over each whole text."""
    rng = np.random.default_rng(14)
    m = hmm_lm.first_model(rng.integers(1, 50, 30).astype(float), 3)
    m["moves"] = rng.dirichlet(np.ones(3), 3)
    texts = [rng.integers(0, 30, k) for k in (1, 2, 7, 8, 9, 40, 65, 17)]
    start, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((30, 3))
    for x in texts:
        e = m["emissions"][x]
        f, b = [m["start"] * e[0]], [np.ones(3)]
        for t in range(1, len(x)):
            f.append(f[-1] @ m["moves"] * e[t])
        for t in range(len(x) - 1, 0, -1):
            b.append(m["moves"] @ (e[t] * b[-1]))
        b, z = b[::-1], f[-1].sum()
        start += f[0] * b[0] / z
        for t in range(len(x)):
            emissions[x[t]] += f[t] * b[t] / z
            if t:
                moves += m["moves"] * np.outer(f[t - 1], e[t] * b[t]) / z
    for got, want in zip(hmm_lm.text_counts(texts, m, 8), (start, moves, emissions), strict=True):
        assert np.abs(got - want).max() < 1e-9


def test_language_model_by_brute_force(spark):
    """Counts, base score and the split of the vocabulary, against plain loops; all one-token texts have a total probability of 1."""
    random.seed(15)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(random.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=random.randrange(1, 12))) for _ in range(80)] + [None, "T1  t1", "unseen t0"]
    every = [*vocabulary, "unseen"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *every])], "doc_id long, text string")
    held = (F.col("doc_id") % 4 == 0) | (F.col("doc_id") >= len(texts) - 1)
    words = [(t or "").lower().split() for t in texts]
    train = [w for i, w in enumerate(words) if i % 4 and i < len(texts) - 1]
    c: dict = {}
    for w in [*train, [0] * len(train)]:
        for x in w:
            c[x] = c.get(x, 0) + 1
    n = sum(c.values())
    for symbols, lookup in ((5, 20), (1, 1), (100, 100), (0, 0)):
        r = {x.doc_id: x for x in hmm_lm.score(d, held, rounds=2, symbols=symbols, lookup=lookup, classes=7).collect()}
        for i, w in enumerate(words):
            assert (r[i].n_tokens, r[i].n_known, r[i].train_tokens) == (len(w) + 1, sum(x in c for x in w) + 1, n)
            assert abs(r[i].base_score - sum(math.log10((c.get(x, 0) + 1) / (n + len(c) + 1)) for x in [*w, 0])) < 1e-9
        # P(t, end) of all different tokens t, with one place for the unseen ones of each of the classes: at most, and nearly, P(length 1) <= 1.
        assert 0 < sum(10 ** r[len(texts) + k].score for k in range(len(every))) < 1


def test_most_frequent_fills_its_bound(spark):
    even = spark.range(5000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("token"), F.lit(3).cast("long").alias("c"))
    got = hmm_lm.most_frequent(even, 1000)
    assert 990 <= len(got) <= 1000 and got == hmm_lm.most_frequent(even.repartition(7), 1000)
    top = spark.range(10).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("token"), (F.col("id") + 100).alias("c"))
    assert [x["c"] for x in hmm_lm.most_frequent(even.union(top), 5)] == [109, 108, 107, 106, 105]
    assert len(hmm_lm.most_frequent(even.union(top), 10_000)) == 5010 and hmm_lm.most_frequent(even, 0) == []


def test_quality(docs, no_docs, spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (3, 0), (3, 1), (None, 1), (8, None)], "doc_id long, quality int")
    r = quality_rules_model.classify(docs, labels, F.lit(True)).collect()
    assert len(r) == len(TEXTS) + 2 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in r)
    assert quality_rules_model.classify(no_docs, labels, F.lit(True)).count() == 0
    one = quality_rules_model.classify(docs, labels.where("quality = 1"), F.lit(True)).collect()
    assert all(x.score > 0.5 for x in one)


def test_samples_of_any_size(spark):
    from cytoflux.llm.common import hash_share, share_bound

    h = spark.range(100_000).select(F.xxhash64("id").alias("h"))
    for n in (100_000, 10**6, 3 * 10**7):
        got = h.where(hash_share(F.col("h"), 2000, n)).count()
        assert abs(got - 2000 * 100_000 / n) < 5 * (2000 * 100_000 / n) ** 0.5 + 1
    assert h.where(hash_share(F.col("h"), 2000, 2000)).count() == 100_000 and h.where(hash_share(F.col("h"), 2000, 0)).count() == 0
    assert all(abs(share_bound(20_000, n) * n / 2**62 - 20_000) < 1 for n in (10**6, 2 * 10**10, 10**13))


def test_rules_and_compiled_column(spark):
    """The column is the logistic function of the weights of the rules that hold; trees are read path by path."""
    tree = "DecisionTree\n  If (feature 1 <= 0.5)\n   If (feature 0 <= -2.0E-4)\n    Predict: 0.0\n   Else (feature 0 > -2.0E-4)\n    Predict: 1.0\n  Else (feature 1 > 0.5)\n   Predict: 1.0\n"
    low, high = ("b", "<=", 0.5), ("b", ">", 0.5)
    assert quality_rules_model.paths(tree, ["a", "b"]) == [(low,), (low, ("a", "<=", -2e-4)), (low, ("a", ">", -2e-4)), (high,)]
    assert quality_rules_model.simplified((("a", ">", 1.0), ("a", ">", 3.0), ("a", "<=", 9.0))) == (("a", "<=", 9.0), ("a", ">", 3.0))
    random.seed(16)
    rows = [(i, random.random(), random.random(), int(i % 3 == 0)) for i in range(300)]
    rows = [(i, a + 0.4 * y, b, y) for i, a, b, y in rows]
    d = spark.createDataFrame(rows, "doc_id long, a double, b double, label int")
    model = quality_rules_model.fit(d)
    assert model["rules"] and model == quality_rules_model.fit(d)
    for r in d.select("a", "b", quality_rules_model.compiled(model).alias("score")).collect():
        holds = lambda rule: all(r[k] <= v if op == "<=" else r[k] > v for k, op, v in rule)  # noqa: E731, B023
        total = model["bias"] + sum(w for rule, w in model["rules"] if holds(rule))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9


def test_statistics_by_hand(spark):
    text = "The  cat (sat) on www.mat.org!\n\nThe  cat 12\nextraordinarily # done."
    r = quality_rules_model.with_statistics(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    words, n = text.split(), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    want = {
        "log_chars": math.log1p(n), "mean_word": n / len(words), "symbols": 1 / n, "bars": 0, "capitals": 2 / n, "exclaims": 1 / n, "digits": 2 / n, "stops": 3 / n, "lines": 3 / n,
        "distinct_words": len(set(words)) / len(words), "distinct_lines": len(set(lines)) / len(lines), "long_words": sum(len(w) > 12 for w in words) / len(words), "brackets": 2 / n, "links": 1 / len(words),
    }
    assert {k: round(r[0][k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()} and len(want) == len(r[0]) - 1
    assert set(r[1].asDict().values()) == {2, 0.0}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    r = quality_rules_model.op3_rule_ensemble(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert r.where("predicted = quality").count() >= 0.95 * r.count()


def test_pseudonyms_small(docs, no_docs):
    r = pseudonyms.pseudonymise(docs, "k", count="n_replaced")
    assert r.count() == len(TEXTS) + 2 and {x.n_replaced for x in r.collect()} == {0}
    assert sorted((x.text or "") for x in r.collect()) == sorted((x.text or "") for x in docs.collect())
    assert pseudonyms.pseudonymise(no_docs, "k").columns == no_docs.columns


def test_pseudonyms_are_valid_and_linked(spark):
    import re
    from datetime import date

    cards = [f"{n:015d}" for n in range(400_000_000_000_000, 400_000_000_000_200)]
    luhn = lambda s: sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10
    cards = [c + str((10 - luhn(c + "0")) % 10) for c in cards]
    days = [date.fromordinal(date(1999, 1, 1).toordinal() + k).isoformat() for k in range(200)]
    rows = [(i, f"card {c}, born {d}; again {c}") for i, (c, d) in enumerate(zip(cards, days, strict=True))]
    out = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id int, text string"), "k").collect()
    new_cards, new_days = set(), set()
    for (_, old), r in zip(rows, sorted(out), strict=True):
        a, d, b = re.fullmatch(r"card (\d{16}), born (\d{4}-\d\d-\d\d); again (\d{16})", r.text).groups()
        assert a == b and luhn(a) == 0 and a not in old
        assert "1900-01-01" <= date.fromisoformat(d).isoformat() <= "2099-12-31"
        new_cards.add(a)
        new_days.add(d)
    assert len(new_cards) == len(new_days) == 200
    other = pseudonyms.pseudonymise(spark.createDataFrame(rows[:5], "doc_id int, text string"), "other").collect()
    assert all(a.text != b.text for a, b in zip(sorted(out), sorted(other), strict=False))


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("mail a.b@c.example.com.", r"mail user-[0-9a-f]{16}@pseudonym\.invalid\."),
        ("4111-1111-1111-1111", r"\d{4}-\d{4}-\d{4}-\d{4}"),
        ("ip 10.20.30.40.", r"ip \d+\.\d+\.\d+\.\d+\."),
        ("31/12/1999 and 01.02.2003", r"\d\d/\d\d/\d{4} and \d\d\.\d\d\.\d{4}"),
        ("+1 (017) 555-7713 1.2.3.4", r"\+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+"),
        ("call (415) 555-0132 or 415-555-0132.", r"call \(([2-9]\d\d)\) ([2-9]\d\d)-(\d{4}) or \1-\2-\3\."),
        ("+1 415 555 0132", r"\+1 [2-9]\d\d [2-9]\d\d \d{4}"),
        ("+49 30 123 4567", r"\+49 \d\d \d{3} \d{4}"),
        ("ssn 123-45-6789", r"ssn \d{3}-\d\d-\d{4}"),
        ("GB82 WEST 1234 5698 7654 32", r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d"),
        ("b44e15e09fd311c3cf3163b66d5a9875b883d8ce", "[0-9a-f]{40}"),
    ],
)
def test_formats(spark, text, form):
    import re

    r = pseudonyms.pseudonymise(spark.createDataFrame([(text,)], "text string"), "k", count="n").first()
    assert r.n >= 1 and r.text != text and re.fullmatch(form, r.text)


@pytest.mark.parametrize("text", ["4111111111111112", "999.1.1.1", "2023-02-30", "000-12-3456", "GB83WEST12345698765432", "version 2.0. 1999", "a@b", "12345678", "115-555-0132", "415-911-0132"])
def test_invalid_values_stay(spark, text):
    assert pseudonyms.pseudonymise(spark.createDataFrame([(text,)], "text string"), "k").first().text == text


def feistel_by_hand(key, kind, a, b, size_a, size_b):
    for k in range(pseudonyms.ROUNDS):
        value = int(hashlib.sha256(f"{key}|{kind}|{k}|{a if k % 2 else b}".encode()).hexdigest()[:15], 16)
        a, b = (a, (b + value) % size_b) if k % 2 else ((a + value) % size_a, b)
    return a, b


def test_permutations_by_brute_force(spark):
    """All strings of three and four digits, all days, a block of phone and social security numbers: one to one, and equal to a second version."""
    for n in (3, 4):
        u = n // 2
        d = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("x"))
        got = {r.x: r.y for r in d.select("x", pseudonyms.permuted_digits("k", "card", F.col("x")).alias("y")).collect()}
        assert len(set(got.values())) == 10**n
        for x in list(got)[:200]:
            a, b = feistel_by_hand("k", f"card/{n}", int(x[:u]), int(x[u:]), 10**u, 10 ** (n - u))
            assert got[x] == f"{a:0{u}d}{b:0{n - u}d}"
    days = spark.range(73_049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pseudonyms.pseudonymise(days, "k").distinct().count() == 73_049
    phones = [f"+1 ({a}) {b}-{c:04d}" for a in ("017", "211", "212", "911", "989") for b in ("011", "555", "611") for c in range(200)]
    out = [r.text for r in pseudonyms.pseudonymise(spark.createDataFrame([(x,) for x in phones], "text string").coalesce(1), "k").collect()]
    planned = lambda x: x[4] in "23456789" and x[5:7] != "11" and x[9] in "23456789" and x[10:12] != "11"
    assert len(set(out)) == len(phones) and [planned(x) for x in out] == [planned(x) for x in phones]
    numbers = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 665, 667, 899) for b in (1, 99) for c in (1, 2, 9999)]
    out = [r.text for r in pseudonyms.pseudonymise(spark.createDataFrame([(x,) for x in numbers], "text string"), "k").collect()]
    assert len(set(out)) == len(numbers) and all(x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000" for x in out)


def test_pseudonyms_need_a_key(docs):
    with pytest.raises(ValueError, match="key"):
        pseudonyms.pseudonymise(docs, "")


def test_columns_of_the_input_stand_aside(spark):
    d = spark.createDataFrame([(1, "x", "mine")], "doc_id long, text string, hit string")
    out = rows_where(d, ["hit"], lambda f: f.withColumn("hit", F.lit(True)), F.col("hit"))
    assert [tuple(r) for r in out.collect()] == [(1, "x", "mine")]


def test_near_duplicates_do_not_depend_on_the_order_of_rows(spark):
    words = [f"w{i}" for i in range(60)]
    near, far = [*words[:-1], "x"], [f"v{i}" for i in range(60)]
    rows = [(1, words), (2, far), (2, near), (3, far), (3, [*far, "y"]), (4, ["one"] * 9), (2, far)]
    rows = [(i, " ".join(w)) for i, w in rows]
    answers = []
    for order in (rows, rows[::-1]):
        d = spark.createDataFrame([(*r, "mine") for r in order], "doc_id long, text string, component string")
        answers.append((sorted(map(tuple, near_dup.near_duplicates(d).collect())), sorted(map(tuple, near_dup.without_near_duplicates(d).collect()))))
    assert answers[0] == answers[1]
    labels, left = answers[0]
    assert [(i, c) for i, c, _ in labels] == [(1, 1), (2, 1), (2, 2), (2, 2), (3, 2), (3, 2), (4, 4)]
    assert left == [(1, " ".join(words), "mine"), (2, " ".join(far), "mine"), (4, " ".join(["one"] * 9), "mine")]


def test_near_duplicates_of_one_large_bucket(spark, monkeypatch):
    """Chains of texts that share buckets but are not all near each other, cut into many small blocks."""
    monkeypatch.setattr(near_dup, "MEMBERS", 8)
    random.seed(12)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(150):
        w = list(base)
        w[k % 40 * 3] = f"x{k}"
        for _ in range(random.randrange(4)):
            w[random.randrange(120)] = f"y{random.randrange(10**6)}"
        texts.append(w)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == shingle_components(texts)
