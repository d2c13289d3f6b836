r"""License scans by matching template markup against the words of a text.

A template is written in a small markup: plain words are mandatory, ``[[ ... ]]`` is an
optional region and ``{{a,b}}`` stands for a to b replaceable words.  Each template is
compiled into an automaton over words.  A text is accepted where the automaton runs
through, that is where all mandatory wording stands in order, word for word, with only
the optional and replaceable regions free.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import table, with_columns_from
from .license_templates import TEMPLATES

#: Phrases that are counted, and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: What matched is weighed by its mandatory words: ``score`` is m / (m + HALF) for the longest match of m words.
HALF = 8

OUTPUTS = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double"}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+),(\d+)\}\}|[^\s\[\]{}]+")


def mandatory(markup: str) -> list[list[str]]:
    """The mandatory words of a template, by runs that stand together."""
    runs: list[list[str]] = [[]]
    depth = 0
    for m in _MARK.finditer(markup):
        token = m.group()
        depth += (token == "[[") - (token == "]]")
        if token in ("[[", "]]") or m.group(1):
            runs.append([])
        elif not depth:
            runs[-1].append(token)
    return [r for r in runs if r]


class TokenAutomaton:
    """The states of a template: edges on a word or on any word, and free moves."""

    def __init__(self, markup: str) -> None:
        self.on_word: list[dict[bytes, int]] = [{}]
        self.on_any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        opened: list[int] = []
        at = 0
        for m in _MARK.finditer(markup):
            token = m.group()
            if token == "[[":
                opened.append(at)
                at = self._step(at, free=True)
            elif token == "]]":
                start, end = opened.pop(), self._step(at, free=True)
                self.free[start].append(end)
                at = end
            elif m.group(1):
                least, most = int(m.group(1)), int(m.group(2))
                skips = []
                for k in range(most):
                    if k >= least:
                        skips.append(at)
                    at = self._step(at, any_word=True)
                end = self._step(at, free=True)
                for s in skips:
                    self.free[s].append(end)
                at = end
            else:
                at = self._step(at, word=token.encode())
        self.final = at
        self.closed = [self._closure(s) for s in range(len(self.free))]
        runs = mandatory(markup)
        #: Mandatory words that stand together: a text without them cannot match.
        self.anchor = max((" ".join(x) for x in runs), key=len).encode()
        self.weight = sum(map(len, runs))

    def _step(self, at: int, word: bytes | None = None, any_word: bool = False, free: bool = False) -> int:
        new = len(self.free)
        for x, empty in ((self.on_word, {}), (self.on_any, []), (self.free, [])):
            x.append(empty)
        if word is not None:
            self.on_word[at][word] = new
        elif any_word:
            self.on_any[at].append(new)
        elif free:
            self.free[at].append(new)
        return new

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    def accepts(self, words: list[bytes]) -> bool:
        """Does a run over some stretch of ``words`` reach the end?  One pass over the words."""
        live: set[int] = set()
        for w in words:
            after: set[int] = set()
            for s in live | self.closed[0]:
                if w in self.on_word[s]:
                    after |= self.closed[self.on_word[s][w]]
                for x in self.on_any[s]:
                    after |= self.closed[x]
            live = after
            if self.final in live:
                return True
        return False


def _scanner(base: dict[str, str], templates: dict[str, str]):
    def make():
        phrase = re.compile(b"(?<= )(?:" + b"|".join(re.escape(p.encode()) for p in base) + b")(?= )")
        automata = [(label, TokenAutomaton(markup)) for label, markup in sorted(templates.items())]
        weight = {label: a.weight for label, a in automata}
        phrase_words = {label: len(p.split()) for p, label in base.items()}

        def one(text: bytes):
            words = _WORD.findall(text.lower())
            line = b" " + b" ".join(words) + b" "
            places, labels, at, n = [], set(), 0, -1
            for m in phrase.finditer(line):
                n += line.count(b" ", at, m.start())  # blanks since the phrase before
                at = m.start()
                places.append(n)
                labels.add(base[m.group().decode()])
            more = {label for label, a in automata if a.anchor in line and a.accepts(words)}
            longest = max([weight[label] for label in more] + [phrase_words[label] for label in labels], default=0)
            score = longest / (longest + HALF)
            first, last = (min(places), max(places)) if places else (None, None)
            return len(words), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | more)), score

        def compute(column: pa.Array):
            rows = [one(x or b"") for x in column.cast(pa.binary()).to_pylist()]
            return [list(x) for x in zip(*rows, strict=True)]

        return compute

    return make


def scan(docs: DataFrame, text: str = "text", base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Append word count, places of base phrases, labels and score to each row.

    ``score`` grows with the mandatory words of the longest template or phrase that matched: m / (m + 8), so 0 without a match, 0.2 to 0.3 for a
    phrase alone, near 1 for a whole licence text.
    A null or empty text has no words, null ``first_word`` and ``last_word``, empty labels.
    Rows are independent: repeated rows, other columns and empty tables need no care; an
    input column that has an output's name is replaced.
    """
    return with_columns_from(docs, [text], OUTPUTS, _scanner(base, templates))


def op6_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *OUTPUTS)


def template_regex(markup: str) -> str:
    """The same template as a regular expression over words that are set off by blanks."""
    out, depth = [], 0
    for m in _MARK.finditer(markup):
        token = m.group()
        if token == "[[":
            out.append("(?:")
        elif token == "]]":
            out.append(")?")
        elif m.group(1):
            out.append(f"(?: [^ ]+){{{m.group(1)},{m.group(2)}}}")
        else:
            out.append(" " + re.escape(token))
    return "".join(out) + " "


def _sql() -> str:
    phrases = {p: label for p, label in BASE.items()}
    places = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, i - 1 AS place FROM s WHERE array_to_string(ws[i : i + {len(p.split()) - 1}], ' ') = '{p}'" for p, label in phrases.items())
    anchor = lambda markup: max((" ".join(x) for x in mandatory(markup)), key=len)
    more = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label FROM d WHERE contains(line, '{anchor(markup)}') AND regexp_matches(line, '{template_regex(markup)}')" for label, markup in TEMPLATES.items())
    words = {**{label: len(p.split()) for p, label in BASE.items()}, **{label: sum(map(len, mandatory(markup))) for label, markup in TEMPLATES.items()}}
    weights = ", ".join(f"('{label}', {n})" for label, n in words.items())
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), d AS (SELECT *, ' ' || array_to_string(ws, ' ') || ' ' AS line FROM w),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d WHERE regexp_matches(line, ' (cc|general|all) ')),
places AS ({places}),
base AS (
  SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id
), more AS ({more}),
both_kinds AS (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM more),
weights AS (SELECT * FROM (VALUES {weights}) AS v(label, words)),
joined AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels, max(words) AS longest FROM both_kinds JOIN weights USING (label) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a::BIGINT AS first_word, base.z::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(joined.labels, '') AS labels,
       coalesce(longest / (longest + {HALF}), 0.0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN joined USING (doc_id)
"""


OP6_SQL = _sql()
