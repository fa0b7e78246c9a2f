"""Language identification by prediction by partial matching (PPM).

Training counts byte strings of one to four symbols per language over a bounded sample of
labelled documents. A context of three symbols that was seen gives a symbol its share of
the context's count; a symbol it never preceded costs an escape (distinct followers over
followers plus distinct, PPM's method C) and is looked for after the shorter context, down
to equal chances. With the statistics frozen, the code length of every (context, symbol) is
a number, so the trees are flattened into one table of code lengths with a column for each
language, and a text's exact code length is a sum of table rows.

Symbols are bytes with letter case folded (A-Z, and the second byte of two-byte letters),
numbered by frequency; rare bytes share a symbol. Every text starts after three padding
symbols.

Defined results: a text that is null or has no letter is ``und`` with score 0; texts with no
labelled language to learn from are ``und``; ties go to the language whose name sorts first;
equal texts get equal answers; an empty table gives none; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, others
from .tokens import text_bytes

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[0x80:0x9F] += 32
_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Model:
    """``table[row]`` holds bits per language. Rows: (two symbols, symbol), then (node, symbol)."""

    languages: list[str]
    symbol: np.ndarray  # byte -> symbol; 0 pads, the last is for rare bytes
    node: np.ndarray  # three symbols -> node, or -1
    table: np.ndarray

    def bits(self, data: np.ndarray) -> np.ndarray:
        """Code length of one text in each language."""
        n_symbols = np.int32(self.size)
        total = np.zeros(len(self.languages))
        padded = np.zeros(len(data) + 3, np.int32)
        padded[3:] = self.symbol[data]
        for lo in range(0, len(data), 1 << 18):
            s = padded[lo : lo + (1 << 18) + 3]
            two = s[1:-2] * n_symbols + s[2:-1]
            node = self.node[s[:-3] * (n_symbols * n_symbols) + two]
            row = np.where(node >= 0, node + n_symbols * n_symbols, two) * n_symbols + s[3:]
            total += self.table[row].sum(0, dtype=np.float64)
        return total

    @property
    def size(self) -> int:
        return int(self.symbol.max()) + 1


def _sample(docs: DataFrame, lang_col: str, text_col: str, id_col: str, per_language: int) -> DataFrame:
    """About ``per_language`` documents of each language, by a hash of id and text.

    One count per language reaches the driver; no language is gathered in one task.
    """
    chance = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30))
    keep = F.lit(False)
    for lang, n in docs.groupBy(F.col(lang_col)).count().collect():
        keep = keep | ((F.col(lang_col) == lang) & (chance < int(min(1.0, per_language / n) * (1 << 30))))
    return docs.filter(keep).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four folded bytes (0 pads), per language and batch."""
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        by: dict[str, list[np.ndarray]] = {}
        for lang, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:]):
            s = np.zeros(b - a + 3, np.uint32)
            s[3:] = _FOLD[data[a:b]]
            by.setdefault(lang, []).append((s[:-3] << 24) | (s[1:-2] << 16) | (s[2:-1] << 8) | s[3:])
        for lang, found in by.items():
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = 600, symbols: int = 96, max_nodes: int = 40_000) -> Model | None:
    """A model of the labelled ``docs``; None if there are none.

    Bounds: about ``per_language`` documents a language are counted; the ``max_nodes`` most frequent
    contexts of three symbols become nodes.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = (
        _sample(labelled, lang_col, text_col, id_col, per_language)
        .mapInArrow(_grams, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    return fitted(counts, symbols, max_nodes) if len(counts) else None


def fitted(counts: pd.DataFrame, symbols: int = 96, max_nodes: int = 40_000) -> Model:
    """The model of counts of four-byte strings (lang, gram, n)."""
    languages = sorted(counts["lang"].unique())
    lang = np.searchsorted(languages, counts["lang"].to_numpy(str))
    gram, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)

    often = np.bincount(gram & 255, n, 256)
    often[0] = 0
    kept = np.argsort(-often, kind="stable")[: symbols - 2]
    kept = kept[often[kept] > 0]
    size = len(kept) + 2
    number = np.full(256, size - 1, np.int32)
    number[kept] = np.arange(1, len(kept) + 1)
    first = number.copy()
    number[0] = 0  # padding, in contexts
    a, b, c = number[gram >> 24 & 255], number[gram >> 16 & 255], number[gram >> 8 & 255]
    d = first[gram & 255]
    symbol = first[_FOLD]

    two = b * size + c
    context = (a * size + b).astype(np.int64) * size + c
    seen = np.unique(context)
    total = np.bincount(np.searchsorted(seen, context), n, len(seen))
    seen = np.sort(seen[np.argsort(-total, kind="stable")[:max_nodes]])
    node = np.full(size**3, -1, np.int32)
    node[seen] = np.arange(len(seen))

    def lengths(rows: np.ndarray, n_rows: int, weight: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Bits of each symbol after each context, where ``lower`` is what an escape leads to."""
        count = np.bincount(rows, weight, n_rows * size).reshape(n_rows, size)
        distinct, sum_ = (count > 0).sum(1, keepdims=True), count.sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(sum_ > 0, -np.log2(distinct / (sum_ + distinct)), 0.0)
            return np.where(count > 0, -np.log2(count / (sum_ + distinct)), escape + lower)

    table = np.empty((size * size * size + len(seen) * size, len(languages)), np.float32)
    nodes = node[context]
    for k in range(len(languages)):
        own = lang == k
        zero = lengths(d[own], 1, n[own], np.full((1, size), np.log2(size)))
        one = lengths(c[own] * size + d[own], size, n[own], zero)
        pair = lengths(two[own] * size + d[own], size * size, n[own], np.tile(one, (size, 1)))
        deep = own & (nodes >= 0)
        three = lengths(nodes[deep] * size + d[deep], len(seen), n[deep], pair[seen % (size * size)])
        table[: size**3, k] = pair.ravel()
        table[size**3 :, k] = three.ravel()
    return Model(languages, symbol, node, table)


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the language of the shortest code and its share (0 to 1) beside the others'.

    The share is that of 2 to the power of minus the code lengths; for long texts it is close
    to 1 or 0.5.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    answer = fresh(docs, "answer")

    @F.pandas_udf("lang string, score double")
    def best(texts: pd.Series) -> pd.DataFrame:
        m = sent.value
        out = []
        for text in texts:
            raw = (text or "").encode()
            if m is None or not has_letter(raw):
                out.append(("und", 0.0))
                continue
            bits = m.bits(np.frombuffer(raw, np.uint8))
            k = int(bits.argmin())
            out.append((m.languages[k], float(1.0 / np.exp2(np.maximum(bits[k] - bits, -1000.0)).sum())))
        return pd.DataFrame(out, columns=["lang", "score"])


    found = docs.withColumn(answer, best(F.col(text_col)))
    return found.select(*others(docs, lang_col, score_col), F.col(f"{answer}.lang").alias(lang_col), F.col(f"{answer}.score").alias(score_col))


def recognised(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without those in which no language is recognised, learnt from their own labels."""
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = identify(docs, train(docs, lang_col, text_col, id_col), text_col, pred, score)
    return found.filter(F.col(pred) != "und").select(*docs.columns)
