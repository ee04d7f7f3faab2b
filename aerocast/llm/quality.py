"""Quality by compression: zstandard dictionaries of good and of bad
labelled text.

A text is cut into blocks of BLOCK bytes, so that every part of a long one
meets the dictionaries; each block is compressed with either.  The
difference of the two sizes, divided by the text's length, says which class
it resembles; the smaller size by length says how repetitive it is.  A
logistic fit on labelled texts that the dictionaries have not seen makes
of the two a score.

The dictionaries (DICTIONARY bytes each) and three weights are all that is
sent to the executors, whatever the corpus' size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from aerocast.llm import common as c
from aerocast.llm.labelled import logistic, remainder, sample, sigmoid

PER_CLASS = 4000        # labelled texts of each class that the fit reads at most
BLOCK, DICTIONARY, LEVEL = 2048, 1 << 16, 3
BLOCKS_OF_TEXT = 8      # evenly spaced blocks of a sampled text that a dictionary may see


def _blocks(batches):
    for b in batches:
        rows = []
        for text, y in zip(c.column(b, "text").to_pylist(), c.column(b, "y").to_pylist()):
            raw = text.encode()
            at = range(0, len(raw), BLOCK)
            rows += [(raw[i:i + BLOCK], y) for i in at[::max(1, -(-len(at) // BLOCKS_OF_TEXT))]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())],
                                         ["block", "y"])


def dictionary(blocks: list[bytes]) -> bytes:
    """Trained dictionary; where there is too little text to train one, the
    text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICTIONARY] or b"\0" * 8


def compressors(dicts: tuple[bytes, bytes]):
    out = []
    for raw in dicts:
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
    return out


def features(col: pa.Array, by) -> np.ndarray:
    bad, good = by
    data, off = c.text_bytes(col)
    raw = data.tobytes()
    out = np.zeros((len(col), 2))
    for i, (lo, hi) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        if hi > lo:
            blocks = [raw[k:min(k + BLOCK, hi)] for k in range(lo, hi, BLOCK)]
            g = sum(len(good.compress(x)) for x in blocks)
            q = sum(len(bad.compress(x)) for x in blocks)
            out[i] = (q - g) / (hi - lo), min(q, g) / (hi - lo)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", usable=None, per_class: int = PER_CLASS):
    """((bad, good) dictionaries, weights), or None where the sample lacks
    a class."""
    spark = docs.sparkSession
    c.prepare(spark)
    usable = F.coalesce(remainder(4) != 2, F.lit(False)) if usable is None else usable
    rows = c.stored(sample(docs, labels, label, usable, per_class), "quality-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    blocks = (rows.where(half == 0).select("text", "y").mapInArrow(_blocks, "block binary, y int")
              .orderBy(F.xxhash64("block")).collect())
    dicts = tuple(dictionary([bytes(r.block) for r in blocks if r.y == v]) for v in (0, 1))
    if not {0, 1} <= {r.y for r in blocks}:
        return None

    def run(batches):
        by = compressors(dicts)
        for b in c.slices(batches):
            f = features(c.column(b, "text"), by)
            yield pa.RecordBatch.from_arrays([pa.array(f[:, 0]), pa.array(f[:, 1]), c.column(b, "y")], ["a", "b", "y"])
    seen = rows.where(half == 1).select("text", "y").mapInArrow(run, "a double, b double, y int").collect()
    if not {0, 1} <= {r.y for r in seen}:
        return None
    return dicts, logistic(np.array([[r.a, r.b] for r in seen]), np.array([r.y for r in seen]), ridge=1e-6)


def score(docs: DataFrame, model) -> DataFrame:
    """All columns of ``docs`` plus ``quality_score`` in 0 to 1.

    Null and empty texts get the score of no evidence (the intercept's),
    every text 0.5 if there is no model.  Texts are read whole; repeated
    rows get equal scores; columns other than ``text`` are never inputs."""
    spark = docs.sparkSession
    c.prepare(spark)
    dicts, weights = model or ((b"\0" * 8, b"\0" * 8), np.zeros(3))
    sent = spark.sparkContext.broadcast((dicts, weights))
    src = docs.drop("quality_score")

    def run(batches):
        dicts, w = sent.value
        by = compressors(dicts)
        for b in c.slices(batches):
            f = features(c.column(b, "text"), by)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sigmoid(f @ w[:2] + w[2]))], [*b.schema.names, "quality_score"])
    return src.mapInArrow(run, src.withColumn("quality_score", F.lit(0.0)).schema)
