"""SentencePiece (merge type) encoding through a table of last tokens, and decoding.

For a merge vocabulary each prefix of a text has one last token: the token that ends its
encoding.  An automaton over all pieces names the tokens that end at a position.  Of these
just one, with start j, is such that the last token of the prefix of length j and itself are
a compatible pair: encoding their joint text gives the two again.  The table is filled from left
to right, and the ids are read backwards from its end.

No piece has a blank mark after another character, so a text is cut before each blank mark that follows
another character, and the parts are encoded one by one; frequent parts are kept.  Pieces of
equal score (runs of blank marks) have no unique order, so parts that hold such a run are encoded by
plain merging.
"""

from __future__ import annotations

import heapq
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, table, with_columns_from

MARK = "▁"
#: Parts that a worker keeps encoded.
KEPT_PARTS = 300_000
#: Where a part ends in such marks, they may be encoded on their own.
PUNCTUATION = ".,!#*$%&|\"'?;:)"
OUTPUTS = {"ids": "array<int>"}


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """The vocabulary of a model file and the two directions."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge models with byte fallback and without text normalisation are known")
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        for i, p in enumerate(model.pieces):
            shown = p.piece.replace(MARK, " ").encode()
            if p.type == 1:
                self.score[p.piece], self.id_of[p.piece] = p.score, i
            elif p.type == 6:
                self.byte_id[int(p.piece[3:5], 16)] = i
                shown = bytes([int(p.piece[3:5], 16)])
            elif p.type == 2:
                shown = b" \xe2\x81\x87 "
            else:
                shown = b""
            self.bytes_of.append(shown)
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id_of):
            raise ValueError("a piece has a blank mark inside")
        self.joined = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        inside = {c for p in self.id_of if len(p) > 1 for c in p}
        alone = "" if "\n" in inside else "\n"
        self.parts = re.compile(f"{alone}|{MARK}*[^{MARK}{alone}]+|{MARK}+") if alone else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        seen: dict[float, str] = {}
        tied = {p for p, s in self.score.items() if s in seen or seen.update({s: p})}
        self.tied_scores = {self.score[p] for p in tied}
        self.history: dict[str, tuple | None] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.id_of:
            if self._steps(p) is not None:
                self.automaton.add_word(p, (len(p), p))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.part_ids: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best pair first, the leftmost of equals; O(n log n)."""
        return self._merge(text)[0]

    def _merge(self, text: str):
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        score = self.score
        heap = [(-score[p], i, 1, p) for i in range(n - 1) if (p := text[i : i + 2]) in score]
        heapq.heapify(heap)
        steps = []
        while heap:
            s, i, left, piece = heapq.heappop(heap)
            j = after[i] if symbols[i] is not None else n
            if j >= n or symbols[i] is None or len(symbols[i]) != left or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            steps.append((-s, symbols[0], i == 0, piece, after[i] >= n))
            if before[i] >= 0 and (p := symbols[before[i]] + piece) in score:
                heapq.heappush(heap, (-score[p], before[i], len(symbols[before[i]]), p))
            if after[i] < n and (p := piece + symbols[after[i]]) in score:
                heapq.heappush(heap, (-score[p], i, len(piece), p))
        return [x for x in symbols if x is not None], steps

    def _steps(self, token: str) -> tuple | None:
        """How merging builds ``token``: (score, first symbol, last symbol) after each step; None if it doesn't."""
        if token not in self.history:
            out, steps = self._merge(token)
            if len(out) != 1:
                self.history[token] = None
            else:
                first, last, rows = token[0], token[-1], []
                for s, _, at_start, piece, at_end in steps:
                    first, last = piece if at_start else first, piece if at_end else last
                    rows.append((s, first, last))
                self.history[token] = (token[0], token[-1], tuple(rows))
        return self.history[token]

    def compatible(self, left: str, right: str) -> bool:
        """Does merging the joint text of two tokens give the two again?

        Both are built side by side, the better step first; they stay apart unless at some
        time the last symbol of the left and the first of the right merge before either's next step.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is not None:
            return known
        a, b = self._steps(left), self._steps(right)
        found = a is not None and b is not None
        if found:
            score, end, start, i, j = self.score, a[1], b[0], 0, 0
            x, y = a[2], b[2]
            while True:
                own = x[i][0] if i < len(x) else None
                other = y[j][0] if j < len(y) else None
                across = score.get(end + start)
                if across is not None and (own is None or across > own) and (other is None or across >= other):
                    found = False
                    break
                if own is None and other is None:
                    break
                if other is None or (own is not None and own >= other):
                    end, i = x[i][2], i + 1
                else:
                    start, j = y[j][1], j + 1
        if len(self.pairs) > 250_000:
            self.pairs.clear()
        self.pairs[key] = found
        return found

    def tokens(self, part: str) -> list[str]:
        """Tokens of a part; a character without a piece stays a token of its own."""
        if self.tied_scores and MARK + MARK in part:
            return self.merged(part)
        n = len(part)
        last: list[str] = [""] * (n + 1)
        pairs, known = self.pairs, self.id_of
        for end, (size, piece) in self.automaton.iter(part):
            end += 1
            if last[end]:
                continue
            start = end - size
            if start:
                p = last[start] or part[start - 1]  # a character that no piece ends at is a token
                if p in known:
                    fits = pairs.get((p, piece))
                    if not (self.compatible(p, piece) if fits is None else fits):
                        continue
            last[end] = piece
        out = []
        while n:
            out.append(last[n] or part[n - 1])
            n -= len(out[-1])
        return out[::-1]

    def encode_part(self, part: str) -> bytes:
        ids = array("i")
        for t in self.tokens(part):
            i = self.id_of.get(t)
            if i is None:
                ids.extend([self.byte_id[b] for b in t.encode()])
            else:
                ids.append(i)
        return ids.tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit numbers."""
        keep, joined = self.part_ids, self.joined
        split = [self.parts.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        new = set().union(*split).difference(keep)
        added = set(new)
        for part in new:
            head = part.rstrip(PUNCTUATION)
            if head and len(head) < len(part) and part[len(head) - 1 : len(head) + 1] not in joined:
                tail = part[len(head) :]  # no piece spans this place, so no merge does
                for x in (head, tail):
                    if x not in keep:
                        keep[x] = self.encode_part(x)
                        added.add(x)
                keep[part] = keep[head] + keep[tail]
            else:
                keep[part] = self.encode_part(part)
        raw = [b"".join(map(keep.__getitem__, parts)) for parts in split]
        for part in added if len(keep) > KEPT_PARTS else [p for p in added if len(p) >= 40]:
            del keep[part]
        return raw

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_all([text])[0]).tolist()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.prefix and raw[:1] == b" " and ids and self.bytes_of[ids[0]][:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


def piece_table(path: str) -> PieceTable:
    """The table of a worker process, built once."""
    return kept(f"pieces {path}", lambda: PieceTable(path))


def _id_lists(raw: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, raw)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), np.int32)))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """Append ``ids``, the encoding of each whole text, without begin and end ids; a null text counts as empty.

    With ``decoded`` the same pass appends the text that the ids decode to.  Rows are independent; an input
    column that has an output's name is replaced.
    """
    path = path or model_path()

    def make():
        t = piece_table(path)

        def compute(column: pa.Array):
            raw = t.encode_all([x or "" for x in column.to_pylist()])
            back = [[t.decode(array("i", r).tolist()) for r in raw]] if decoded else []
            return [_id_lists(raw), *back]

        return compute

    return with_columns_from(docs, [text], OUTPUTS | ({"decoded": "string"} if decoded else {}), make)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Append ``decoded``, the text of each row's ids; null ids as none."""
    path = path or model_path()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded") + ", decoded string"

    def run(batches):
        t = piece_table(path)
        for batch in batches:
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "decoded"]
            names = [n for n in batch.schema.names if n != "decoded"]
            lists = batch.column(batch.schema.get_field_index(ids))
            flat, ends = lists.flatten().to_pylist(), lists.value_lengths().fill_null(0).to_pylist()
            texts, at = [], 0
            for n in ends:
                texts.append(t.decode(flat[at : at + n]))
                at += n
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, schema)


def op4_piece_codec(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, decoded=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
