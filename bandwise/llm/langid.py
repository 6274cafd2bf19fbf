"""Language ID by cross-parsing entropy against suffix automata of labelled text.

For every language a suffix automaton of a bounded labelled sample is built.
A text is then parsed greedily into phrases, each the longest string that
occurs in the sample; the language that needs the fewest phrases per symbol
wins (Ziv and Merhav's cross-parsing). All texts of a block are parsed in lock
step with numpy, one symbol per step. While states x alphabet stays below
``DENSE`` the transitions are one table; beyond that (large alphabets, many languages) only the
edges that exist are kept, sorted by state and symbol (both forms parse alike).

Bounds, all parameters: of each language the ``rows_per_lang`` distinct excerpts that hash lowest are
learned. An excerpt is ``chars_per_row`` code points of a text, from an offset that its hash spreads over the
whole text, and has a letter. Texts are parsed whole, in pieces of ``PIECE`` symbols.

Defined results: null text or a text without a letter gives ``und`` with score
0; no labelled rows at all gives ``und`` everywhere (``has_letter`` tells these from the others); ties go to the language
that sorts first; extra columns are ignored; repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwise.llm.common import shipped

PIECE = 512  # symbols parsed in a row; a phrase ends at a piece's end in every language alike
BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 20
DENSE = 1 << 23  # cells of a dense transition table, over all languages
UNDETERMINED = "und"


class Automaton:
    """Suffix automaton of a string, as lists (Blumer et al. 1985, online construction)."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for ch in text:
            cur = self._state({}, self.length[last] + 1)
            p = last
            while p >= 0 and ch not in self.next[p]:
                self.next[p][ch] = cur
                p = self.link[p]
            if p < 0:
                self.link[cur] = 0
            else:
                q = self.next[p][ch]
                if self.length[q] == self.length[p] + 1:
                    self.link[cur] = q
                else:
                    twin = self._state(dict(self.next[q]), self.length[p] + 1)
                    self.link[twin] = self.link[q]
                    while p >= 0 and self.next[p].get(ch) == q:
                        self.next[p][ch] = twin
                        p = self.link[p]
                    self.link[q] = self.link[cur] = twin
            last = cur

    def _state(self, edges: dict[str, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1


def symbols(text: str) -> str:
    """Lower-cased letters; every run of other characters becomes one space."""
    return " ".join("".join(c if c.isalpha() or c.isspace() else " " for c in text.lower()).split())


class Model:
    """Transitions of all languages over one shared alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        texts = {k: " ".join(symbols(t) for t in samples[k]) for k in self.langs}
        alphabet = sorted(set("".join(texts.values())) | {" "})
        self.size = len(alphabet) + 1  # the last class: letters that no sample has
        place = {c: i for i, c in enumerate(alphabet)}
        self.classes = np.full(0x10000, -1, np.int32)  # -1: not a letter
        for i in range(0x10000):
            if chr(i).isalpha():
                self.classes[i] = place.get(chr(i), self.size - 1)
        self.codes = np.array([ord(c) for c in alphabet], np.uint32)  # sorted, as the alphabet is
        self.space = place[" "]
        state, symbol, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.alone, first, n_states = [], [], 0
        self.roots = []
        for k in self.langs:
            a = Automaton(texts[k])
            edges = np.array([(s, place[c], t) for s, e in enumerate(a.next) for c, t in e.items()], np.int64).reshape(-1, 3)
            self.roots.append(n_states)
            alone = n_states + len(a.next)  # stands behind a symbol that the sample lacks: a phrase of its own
            begin = np.full(self.size, alone)  # where a new phrase that begins with the symbol stands
            begin[edges[edges[:, 0] == 0, 1]] = edges[edges[:, 0] == 0, 2] + n_states
            first.append(begin)
            state.append(edges[:, 0] + n_states)
            symbol.append(edges[:, 1])
            to.append(edges[:, 2] + n_states)
            n_states = alone + 1
        self.first = np.concatenate(first) if first else np.zeros(0, np.int64)  # by language and symbol
        state, symbol, to = (np.concatenate(x) for x in (state, symbol, to))
        self.dense = n_states * self.size <= DENSE
        if self.dense:
            # states x alphabet x 2 stays below 2**31
            table = np.full((n_states, self.size), -1, np.int32)
            table[state, symbol] = to
            bounds = [*self.roots, n_states]
            for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                part = table[lo:hi]
                ends = part < 0
                np.copyto(part, first[i][None, :].astype(np.int32), where=ends)
                part *= self.size * 2
                part |= ends
            self.table = table.ravel()
        else:
            key = state * self.size + symbol
            order = np.argsort(key)
            self.keys, self.goal = key[order], to[order].astype(np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Symbol classes, runs of non-letters as one space, none at the ends."""
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = self.classes[np.minimum(code, 0xFFFF)]
        high = np.flatnonzero(code > 0xFFFF)
        if len(high):
            at = np.minimum(np.searchsorted(self.codes, code[high]), len(self.codes) - 1)
            alpha = {x: chr(x).isalpha() for x in set(code[high].tolist())}
            other = np.array([self.size - 1 if alpha[x] else -1 for x in code[high].tolist()], np.int32)
            c[high] = np.where(self.codes[at] == code[high], at, other)
        letter = c >= 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first non-letter after a letter
        c = np.where(letter, c, self.space)[keep]
        return c[:-1] if len(c) and not letter[-1] and c[-1] == self.space else c

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases per text and language, shape (texts, languages)."""
        owner, piece = [], []
        for i, c in enumerate(coded):
            for at in range(0, len(c), PIECE):
                owner.append(i)
                piece.append(c[at : at + PIECE])
        total = np.zeros((len(coded), len(self.langs)), np.int64)
        if not piece or not self.langs:
            return total
        sizes = np.array([len(p) for p in piece])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        kind = self.table.dtype if self.dense else np.int32
        grid = np.zeros((int(sizes[0]), len(piece)), kind)
        for col, k in enumerate(order.tolist()):
            grid[: len(piece[k]), col] = piece[k]
        alive = np.searchsorted(-sizes, -np.arange(len(grid)), side="left")  # pieces longer than each step
        roots = np.array(self.roots, kind)[:, None] * (self.size if self.dense else 1)
        state = np.repeat(roots, len(piece), axis=1)
        count = np.ones(state.shape, np.int32)
        offset = (np.arange(len(self.langs)) * self.size)[:, None]
        for step, n in enumerate(alive.tolist()):
            now, x = state[:, :n], grid[step, :n]
            if self.dense:
                y = self.table[now + x]
                ends, state[:, :n] = y & 1, y >> 1
            else:
                key = now.astype(np.int64) * self.size + x
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ends = self.keys[at] != key
                state[:, :n] = np.where(ends, self.first[offset + x], self.goal[at])
            if step:
                count[:, :n] += ends  # a piece's first symbol begins its first phrase
        np.add.at(total, np.array(owner)[order], count.T)
        return total


_MODELS: dict[int, Model] = {}


def _model(samples: dict[str, list[str]]) -> Model:
    key = hash(tuple((k, tuple(v)) for k, v in sorted(samples.items())))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(samples)
    return _MODELS[key]


def predict_batches(batches, samples: dict[str, list[str]]):
    model = _model(samples)
    for batch in batches:
        row, texts = batch.column("row"), batch.column("text")
        lo = 0
        while lo < batch.num_rows:
            coded, used = [], 0
            while lo + len(coded) < batch.num_rows and len(coded) < BLOCK_ROWS and used < BLOCK_CHARS:
                t = texts[lo + len(coded)].as_py()
                coded.append(model.encode(t or ""))
                used += len(coded[-1])
            n = np.array([len(c) for c in coded])
            total = model.phrases(coded)
            rate = total / np.maximum(n, 1)[:, None]
            known = (n > 0) & (len(model.langs) > 0)
            best = rate.argmin(axis=1) if len(model.langs) else np.zeros(len(n), int)
            if len(model.langs) > 1:
                two = np.partition(rate, 1, axis=1)[:, :2]
                score = 1 - two[:, 0] / np.maximum(two[:, 1], 1e-12)
            else:
                score = np.ones(len(n))
            score = np.where(known, np.clip(score, 0, 1), 0.0)
            names = [model.langs[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            low = np.where(known, rate.min(axis=1) if len(model.langs) else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays(
                [row.slice(lo, len(coded)), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.float64()), pa.array(n > 0)],
                names=["row", "lang_pred", "score", "phrases_per_symbol", "has_letter"],
            )
            lo += len(coded)


def learn(docs: DataFrame, rows_per_lang: int = 16, chars_per_row: int = 800) -> dict[str, list[str]]:
    """The bounded labelled sample: per language the distinct excerpts with the smallest hashes.

    Only hashes and ids travel to the ranking (copies merge before the shuffle); the excerpts of the chosen
    rows are read again by their few ids.
    """
    begin = F.pmod(F.xxhash64(F.lit("offset"), "text"), F.greatest(F.length("text") - chars_per_row + 1, F.lit(1))).cast("int") + 1
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rows = rows.select("doc_id", "lang", F.substring("text", begin, F.lit(chars_per_row)).alias("excerpt")).where(F.col("excerpt").rlike(r"\p{L}"))
    distinct = rows.groupBy("lang", F.xxhash64(F.lit("langid"), "excerpt").alias("h")).agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = distinct.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rows_per_lang).select("lang", "doc_id").collect()
    ids = sorted({r.doc_id for r in chosen})  # at most rows_per_lang for each language
    taken = rows.where(F.col("doc_id").isin(ids)).groupBy("lang", "doc_id").agg(F.min("excerpt").alias("text"))
    out: dict[str, list[str]] = {}
    for r in sorted(taken.collect(), key=lambda r: (r.lang, r.doc_id)):
        if symbols(r.text):
            out.setdefault(r.lang, []).append(r.text)
    return out


def predict(docs: DataFrame, samples: dict[str, list[str]], carried: list[str]) -> DataFrame:
    """row (a struct of the carried columns), lang_pred, score, phrases_per_symbol and has_letter of every row, from its whole text alone."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col("text").cast("string").alias("text"))
    result = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double").add("phrases_per_symbol", "double").add("has_letter", "boolean")
    return rows.mapInArrow(shipped(__name__, "predict_batches", samples=samples), result)


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def labelled(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from (not held out), as doc_id, text and lang."""
    columns = [F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"))]
    return docs.select(*columns).where(~held_out())


def language_id(docs: DataFrame, rows_per_lang: int = 16, chars_per_row: int = 800) -> DataFrame:
    """doc_id, held_out, lang_pred, score, phrases_per_symbol and has_letter of every row."""
    docs = docs.select(*(F.col(c).cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"))))
    found = predict(docs, learn(labelled(docs), rows_per_lang, chars_per_row), ["doc_id"]).select("row.doc_id", "*").drop("row")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "phrases_per_symbol", "has_letter")
