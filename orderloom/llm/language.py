"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content zstandard dictionary cut from its training texts. A text is
compressed whole, in blocks, once for each dictionary, and the sizes are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, key_remainder

#: The fitted sample: so many different texts of each language by smallest hash, and so much of each.
TEXTS, CHARS = 64, 1024
#: Languages are a dimension; more than this is an error.
MAX_LANGUAGES = 1000
BLOCK = 2048
#: Texts of a task at a time.
SLICE = 500
UNKNOWN = "und"
#: Rejected: texts of at least SHORT bytes whose best two sizes differ by less than this share. A
#: shorter text is only a few bytes when compressed, so its margin says little.
MARGIN, SHORT = 0.001, 200

# Zstandard settings.
LEVEL, MIN_MATCH = 12, 3


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary content by language, the most frequent language first. Rows without text or
    language teach nothing; no rows give no languages."""
    rows = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.selectExpr(f"`{lang}` as lang", f"lower(substring(`{text}`, 1, {CHARS})) as start", f"xxhash64(`{text}`) as h")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Equal starts count once. Each task keeps TEXTS rows of a language before the shuffle by language.
    first = rows.groupBy("lang", "start").agg(F.min("h").alias("h")).selectExpr("*", "row_number() over (partition by lang order by h, start) as n").where(f"n <= {TEXTS}")
    starts: dict[str, list] = {r["lang"]: [] for r in sorted(counts, key=lambda r: (-r["count"], r["lang"]))}
    for r in first.select("lang", "n", "start").collect():
        starts[r["lang"]].append((r["n"], r["start"]))
    return {k: "\n".join(t for _, t in sorted(v)).encode() for k, v in starts.items()}


class Compressors:
    """One compressor for each language."""

    def __init__(self, contents: dict[str, bytes]):
        self.names = list(contents)
        self.each = []
        for content in contents.values():
            parameters = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(content), source_size=BLOCK, min_match=MIN_MATCH,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            data = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.each.append(zstandard.ZstdCompressor(dict_data=data, compression_params=parameters))

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected. Equal sizes go to the more frequent
        language; each byte saved doubles the odds that the score is made of."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = b"\n" + text.lower().encode()
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.each], float)
        best = int(sizes.argmin())
        score = 1.0 / np.exp2(-np.minimum(sizes - sizes[best], 1000)).sum()
        if len(sizes) == 1:
            return self.names[best], score, False
        second = np.partition(sizes, 1)[1]
        narrow = bool(len(data) >= SHORT and second - sizes[best] < MARGIN * second)
        return self.names[best], score, narrow


def predict(df: DataFrame, contents: dict[str, bytes], text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns with lang_pred, score and rejected, for every row.

    lang_pred is a learned language, or ``und`` (score 0, rejected) for a text that is null or has
    no letter. rejected also marks texts whose margin is narrow. No learned language: all ``und``.
    """
    # Bounded: MAX_LANGUAGES times TEXTS times CHARS at the most.
    sent = df.sparkSession.sparkContext.broadcast(contents)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carry).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Compressors(sent.value)
        for batch in batches:
            found = [judge.judge(t) for t in batch.column(len(carry)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(carry)],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=[*carry, "lang_pred", "score", "rejected"],
            )

    return df.select(*carry, F.col(text).alias("_text")).mapInArrow(run, schema + ", lang_pred string, score double, rejected boolean")


def keep(df: DataFrame, contents: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    sent = df.sparkSession.sparkContext.broadcast(contents)
    at = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Compressors(sent.value)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                found = [not judge.judge(t)[2] for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(found, pa.bool_()))

    return df.mapInArrow(run, df.schema)


#: A document with this remainder is held out and teaches nothing.
FOLDS = 5


def identify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", key_remainder("doc_id", FOLDS) == 0)
    contents = fit(docs.where("not held_out"))
    docs = docs.selectExpr("cast(doc_id as bigint) as doc_id", "held_out", "text")
    return predict(docs, contents, carry=("doc_id", "held_out"))
