"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language are summed over all training rows. The
log-probability matrix (languages x buckets) is broadcast; numpy scores batches
of documents from the buckets that occur in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Orders of the character n-grams, and the number of hash buckets.
ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: More labels than these are no languages; with BUCKETS they bound the matrix to 64 MB.
MAX_LANGUAGES = 1000
SMOOTHING = 0.5
UNKNOWN = "und"
#: Characters taken up at once.
CHUNK = 1 << 18


def has_letter(text: str) -> bool:
    """Whether the text has a character of Unicode's category L; numerals such as ½ are none."""
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """How many n-grams fall into each bucket. White space, digits and signs count as one blank; a blank is before and after the text.

    The n-grams are taken up by the character at which they end, some characters at once, so each counts once.
    """
    text = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(codes), CHUNK):
        for order in ORDERS:
            part = codes[max(0, at - order + 1) : at + CHUNK].astype(np.uint64)
            if len(part) < order:
                continue
            key = np.full(len(part) - order + 1, order, np.uint64)
            for k in range(order):
                key = (key * np.uint64(0x100000001B3)) ^ part[k : len(part) - order + 1 + k]
            key *= np.uint64(0x9E3779B97F4A7C15)
            total += np.bincount((key >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), minlength=BUCKETS)
    return total


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            name = lang.as_py()
            if name not in totals:
                totals[name] = np.zeros(BUCKETS, np.int64)
            totals[name] += counts(text.as_py())
    for name, total in totals.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"lang": [name] * len(some), "bucket": some.astype(np.int32), "n": total[some]})


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities by bucket, from rows with a label and a text that has letters."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null"
    )
    found = (
        rows.mapInArrow(count_batches, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    labels = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if labels > MAX_LANGUAGES:
        raise ValueError(f"at most {MAX_LANGUAGES} languages can be learned, and there are more labels")
    # A row for each language and bucket, whatever the size of the corpus.
    table = found.toPandas()
    languages = sorted(table["lang"].unique())
    matrix = np.full((len(languages), BUCKETS), SMOOTHING)
    place = {name: i for i, name in enumerate(languages)}
    np.add.at(matrix, (table["lang"].map(place).to_numpy(int), table["bucket"].to_numpy(int)), table["n"].to_numpy())
    return languages, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)


def language_udf(spark: SparkSession, languages: list[str], matrix: np.ndarray):
    """A function of a text column: struct(lang_pred, score)."""
    model = spark.sparkContext.broadcast((languages, np.ascontiguousarray(matrix.T)))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def identify(texts: pa.Array) -> pa.Array:
        names, weights = model.value
        langs, scores = [], []
        for text in texts:
            text = text.as_py()
            if not names or text is None or not has_letter(text):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            found = counts(text)
            some = np.flatnonzero(found)
            log = found[some].astype(np.float64) @ weights[some]
            best = int(np.argmax(log))
            langs.append(names[best])
            scores.append(float(1 / np.exp(np.maximum(log - log[best], -700)).sum()))
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"]
        )

    return identify


def predict(
    docs: DataFrame, languages: list[str], matrix: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each row's id, lang_pred and score, the probability of that language.

    Priors are equal. Null texts, texts without a letter, and all texts when no language was
    learned give UNKNOWN with score 0. Of equal probabilities, the language that sorts first wins.
    Repeated rows and rows without an id are handled like all others; other columns aren't read.
    """
    found = language_udf(docs.sparkSession, languages, matrix)(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), found.alias("found"))
    return rows.select("id", "found.lang_pred", "found.score")


def keep_known(
    docs: DataFrame, languages: list[str], matrix: np.ndarray, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The documents whose language is known with a probability of at least `least`, with all their columns."""
    found = language_udf(docs.sparkSession, languages, matrix)(F.col(text_col))
    return docs.filter(found["score"] >= least)
