"""Language identification by n-gram Bloom filters over bitmasks (operator 2).

One filter serves all languages: a table whose rows are bitmasks with one bit
per language. An n-gram has ``HASHES`` rows; the AND of these rows is the set of
languages that contain it. Per text the bits are counted by language, corrected
for the share of false positives that the fill of each language's bit column
predicts, and the largest corrected share decides.

Training reads at most about ``SAMPLE_PER_LANGUAGE`` labelled texts per
language, drawn by a hash of id and text. Prediction uses nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.names import quoted
from starmart.llm.text import batches, mix

UNDETERMINED = "und"
SIZES = (1, 2, 3)
HASHES = 3
ROW_BITS = 18
SAMPLE_PER_LANGUAGE = 1500
# An n-gram belongs to a language if it makes up this share of its n-grams.
LEAST_SHARE = 2e-5
BATCH_CHARS = 1 << 18
MAX_LANGUAGES = 1024


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts with every run of other characters
    as one blank, and the number of the text of each."""
    joined = "\x00".join(t.lower().replace("\x00", " ") for t in texts) + "\x00"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(codes == 0) - (codes == 0)
    seen, at = np.unique(codes, return_inverse=True)
    is_letter = np.array([chr(c).isalpha() for c in seen.tolist()])[at]
    codes = np.where(is_letter, codes, 32).astype(np.uint64)
    keep = is_letter | np.concatenate([[True], is_letter[:-1]])
    return codes[keep], owner[keep]


def ngram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of SIZES and the number of their text. N-grams lie
    within a word and its two blanks; a lone blank is none."""
    codes, owner = _letters(texts)
    hashes, owners = [], []
    for n in SIZES:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        fits = owner[:m] == owner[n - 1 :]
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + codes[i : i + m]
            if 0 < i < n - 1 or n == 1:
                fits &= codes[i : i + m] != 32
        hashes.append(mix(h[fits]))
        owners.append(owner[:m][fits])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _rows(hashes: np.ndarray) -> list[np.ndarray]:
    """The HASHES table rows of each n-gram."""
    mask = np.uint64((1 << ROW_BITS) - 1)
    return [
        ((hashes >> np.uint64(i * ROW_BITS)) & mask).astype(np.int64) for i in range(HASHES)
    ]


@dataclass(frozen=True)
class LanguageFilter:
    """``table``: (rows, bytes) bitmask over ``languages``."""

    languages: tuple[str, ...]
    table: np.ndarray

    @staticmethod
    def build(grams: dict[str, np.ndarray]) -> LanguageFilter:
        languages = tuple(sorted(grams))
        table = np.zeros((1 << ROW_BITS, max(1, (len(languages) + 7) // 8)), np.uint8)
        for place, language in enumerate(languages):
            for rows in _rows(grams[language]):
                table[rows, place // 8] |= np.uint8(1 << (place % 8))
        return LanguageFilter(languages, table)

    def false_positives(self) -> np.ndarray:
        """Per language, the chance that a foreign n-gram passes."""
        fill = np.array(
            [
                ((self.table[:, i // 8] >> np.uint8(i % 8)) & 1).mean()
                for i in range(len(self.languages))
            ]
        )
        return fill**HASHES

    def shares(self, texts: list[str]) -> np.ndarray:
        """(texts, languages): corrected share of n-grams; -1 without n-grams."""
        hashes, owner = ngram_hashes(texts)
        masks = None
        for rows in _rows(hashes):
            masks = self.table[rows] if masks is None else masks & self.table[rows]
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        out = np.empty((len(texts), len(self.languages)))
        for byte in range(self.table.shape[1]):
            # One count per text and byte value, then per language of that byte.
            grid = np.bincount(
                owner * 256 + masks[:, byte].astype(np.int64), minlength=len(texts) * 256
            ).reshape(len(texts), 256)
            for bit in range(min(8, len(self.languages) - byte * 8)):
                has = (np.arange(256) >> bit) & 1 == 1
                out[:, byte * 8 + bit] = grid[:, has].sum(axis=1)
        chance = self.false_positives()
        size = np.maximum(total, 1)[:, None]
        corrected = (out / size - chance) / np.maximum(1 - chance, 1e-9)
        return np.where(total[:, None] > 0, np.clip(corrected, 0, 1), -1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score (0 to 1). UNDETERMINED with score 0 for a text
        without letters; ties go to the language that sorts first."""
        names, scores = [], []
        for run in batches([len(t or "") for t in texts], BATCH_CHARS):
            shares = self.shares([t or "" for t in texts[run]])
            best = shares.argmax(axis=1) if len(self.languages) else np.zeros(len(shares), int)
            for row, i in zip(shares, best, strict=True):
                known = len(row) > 0 and row[i] >= 0
                names.append(self.languages[i] if known else UNDETERMINED)
                scores.append(float(row[i]) if known else 0.0)
        return names, scores


def held_out(doc_id: Column) -> Column:
    """The quarter of ids that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample: int = SAMPLE_PER_LANGUAGE,
) -> LanguageFilter:
    """Learns from the labelled rows of ``docs``, null texts and labels left out.

    ``sample`` bounds the expected number of texts per language: labels are
    counted first, then each row enters by a hash of its id and text with the chance
    that gives ``sample``; rows that repeat both enter together. The n-grams counted from so many texts are what
    reaches the driver. More than MAX_LANGUAGES labels are refused.
    """
    rows = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    found = {r["lang"]: r["n"] for r in counts.limit(MAX_LANGUAGES + 1).collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return LanguageFilter.build({})
    unit = F.shiftrightunsigned(F.xxhash64("id", "text", F.lit(2)), 11) / float(1 << 53)
    chance = F.create_map(
        *[F.lit(x) for lang, n in found.items() for x in (lang, min(1.0, sample / n))]
    )

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lang, texts in part.groupby("lang")["text"]:
                hashes, _ = ngram_hashes(texts.tolist())
                kept, n = np.unique(hashes, return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": kept.view(np.int64), "n": n})

    grams = (
        rows.where(unit < F.element_at(chance, F.col("lang")))
        .select("lang", "text")
        .mapInPandas(count, "lang STRING, gram BIGINT, n BIGINT")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    kept = {lang: np.zeros(0, np.uint64) for lang in found}
    for lang, part in grams.groupby("lang"):
        n = part["n"].to_numpy()
        enough = n >= max(2, LEAST_SHARE * n.sum()) if n.sum() > 2000 else n >= 1
        kept[lang] = part["gram"].to_numpy(np.int64)[enough].view(np.uint64)
    return LanguageFilter.build(kept)


def identify(
    docs: DataFrame, model: LanguageFilter, text_col: str = "text",
    lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """``docs`` with two more columns: language and score of every whole text.
    Null texts and texts without letters are ``und`` with score 0. An input
    column with the name of an output is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"{lang_out} STRING, {score_out} DOUBLE")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({lang_out: names, score_out: scores})

    # A filter on the results would else be evaluated beside them by a second call.
    predict = predict.asNondeterministic()
    # The row as one column, so that no name of its own clashes.
    kept = [F.col(quoted(c)) for c in docs.columns if c not in (lang_out, score_out)]
    found = docs.select(F.struct(*kept).alias("row"), predict(F.col(text_col)).alias("found"))
    return found.select("row.*", f"found.{lang_out}", f"found.{score_out}")
