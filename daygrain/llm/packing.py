"""Tokenised documents packed into training sequences by vector best-fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.text import pieces
from daygrain.llm.token_files import WordIds
from daygrain.session import written

GROUP = 16384  # pieces packed together
CACHE_WORDS = 1 << 19  # words a worker keeps

_OPEN: dict[str, WordIds] = {}


def _tokenised(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _OPEN:
            _OPEN[path] = WordIds(path, CACHE_WORDS)
        last = np.array([end], np.uint32)
        for batch in batches:
            for part in pieces(batch, limit=1 << 20):
                ids, bounds = _OPEN[path].encode(part.column("text"))
                rows, piece, start, length, crc = [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own = np.concatenate([ids[a:b], last]).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        cut = own[s:s + capacity]
                        rows.append(i), piece.append(k), start.append(s), length.append(len(cut)), crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def best_fit(
    lengths: np.ndarray, capacity: int, documents: int, attention: int, weights: tuple[float, float, float], rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece: longest first, each into the open bin that its rule prefers.

    A bin has three residuals: tokens, documents and attention cost (sum of squared lengths).  A bin is open to a
    piece if all three suffice.  ``norm`` takes the bin whose weighted residual vector is shortest after the piece
    went in, ``dot`` the one with the smallest weighted product of demand and residual; ties go to the oldest bin.
    """
    n = len(lengths)
    top = np.array([capacity, documents, attention], float)
    scale = np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    left = np.empty((max(n, 1), 3))
    name = np.empty(max(n, 1), np.int64)
    used, made, floor = 0, 0, int(lengths.min()) if n else 0
    for step, i in enumerate(order.tolist()):
        size = int(lengths[i])
        need = np.array([size, 1, size * size], float)
        if step % 64 == 0 and used:
            keep = (left[:used, 0] >= floor) & (left[:used, 1] >= 1) & (left[:used, 2] >= floor * floor)
            kept = int(keep.sum())
            left[:kept], name[:kept], used = left[:used][keep], name[:used][keep], kept
        fits = np.flatnonzero((left[:used, 0] >= size) & (left[:used, 1] >= 1) & (left[:used, 2] >= size * size))
        if len(fits):
            rest = left[fits]
            if rule == "norm":
                score = ((((rest - need) / top) ** 2) * scale).sum(axis=1)
            else:
                score = (rest / top * (need / top) * scale).sum(axis=1)
            at = int(fits[np.argmin(score)])
        else:
            at = used
            left[at], name[at] = top, made
            used, made = used + 1, made + 1
        bins[i], offsets[i] = name[at], capacity - int(left[at, 0])
        left[at] -= need
    return bins, offsets


def _packed(capacity, documents, attention, weights, rule):
    def run(key, table):
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity, documents, attention, weights, rule)
        base = int(key[0].as_py()) << 32
        out = table.drop_columns(["pack"])
        return out.append_column("sequence_id", pa.array(base + bins)).append_column("offset", pa.array(offsets))

    return run


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 4096, end: int = 1, documents: int | None = None,
    attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm",
) -> DataFrame:
    """Pieces of tokenised documents (doc_id, text) with their places in sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.  A text's ids come from the tokenizer
    file ``vocabulary``, then ``end``; a longer text is cut every ``capacity`` ids.  A sequence holds at most
    ``capacity`` tokens, ``documents`` pieces and ``attention`` summed squared lengths (None: as much as the tokens
    allow; a single piece must fit).

    Texts are tokenised in one narrow pass.  Only the pieces' numbers are then dealt into groups of about 16,384,
    without regard to any key, so no group grows with the data or with a hot source; each group is packed longest
    first.  A group wastes at most its last bins.  Defined results: a null or empty text is the end id alone; null
    and repeated doc_ids are packed row by row; an empty table gives no rows; other columns are not read.
    """
    documents = documents or capacity
    attention = attention or capacity * capacity
    if attention < capacity * capacity:
        raise ValueError("a piece of full length must fit the attention capacity")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    cut = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenised(vocabulary, capacity, end), schema), "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("pack", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack").applyInArrow(
        _packed(capacity, documents, attention, weights, rule), f"{schema}, sequence_id long, offset long"
    )
