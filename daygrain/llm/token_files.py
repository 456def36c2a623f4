"""Token ids of documents in grammar-compressed files, in the order of their ids, with random access."""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.repair import Shard, compressed, to_bytes
from daygrain.llm.slots import Kept, Runs, blocks, decoded, flattened, interleaved, lines_in_signs, whole_words
from daygrain.llm.text import LOWER, flat
from daygrain.session import shared_path, written

SHARD_IDS = 1 << 21  # ids of a shard, unless one document has more
BATCH = 4 << 20  # bytes of ids in one batch
GROUP = 4096  # shards summed at once

_OPEN: dict[str, "WordIds"] = {}

# what a byte is to the tokenizer's splitter: white space, marks that begin a token after a letter or digit, those, the rest; a
# bar begins none, as it stands inside special tokens' strings
_SPACE, _OTHER, _ALNUM, _MARK = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = _ALNUM
_CLASS[[ord(c) for c in string.punctuation if c != "|"]] = _MARK


# small letters whose normal form and lower case are known to be themselves, up to U+017E
_PLAIN = re.compile("[%s]+" % "".join(c for c in map(chr, range(0x17F)) if c.isalpha() and c == c.lower())).fullmatch


def cuts(body: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the parts between white space; a mark after a letter or digit, and each of ``edges``, begins a part."""
    kind = _CLASS[body]
    inside = kind != _SPACE
    start = np.empty(len(body), bool)
    start[:1] = True
    start[1:] = ~inside[:-1] | ((kind[1:] == _MARK) & (kind[:-1] == _ALNUM))
    start[edges[edges < len(body)]] = True
    start &= inside
    ends = np.empty(len(body), bool)
    ends[-1:] = True
    ends[:-1] = start[1:] | ~inside[1:]
    return np.flatnonzero(start), np.flatnonzero(ends & inside) + 1


class WordIds:
    """Token ids by a tokenizer that drops white space and never joins what ``cuts`` separates."""

    def __init__(self, path: str, kept: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # without normalising and splitting, which leave small letters as they are
        self.terminals = self.tokenizer.get_vocab_size()
        suffix, self.closing = self.tokenizer.model.end_of_word_suffix, None
        if suffix:  # each word ends with an id of its own kind
            self.closing = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.closing[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.ids = Runs(np.uint32)
        self.kept = Kept(self.ids, kept=kept)

    def _fill(self, words: list[bytes]) -> None:
        for i in range(0, len(words), 8192):
            part = decoded(words[i:i + 8192])
            plain = np.array([m is not None for m in map(_PLAIN, part)])
            signs = lines_in_signs([words[i + k] for k in np.flatnonzero(plain).tolist()])
            easy = whole_words(self.bare, signs, self.closing)
            hard = self.tokenizer.encode_batch_fast([part[k] for k in np.flatnonzero(~plain).tolist()], add_special_tokens=False)
            ids, sizes = interleaved(plain, easy, flattened([e.ids for e in hard]))
            self.ids.append(sizes, ids.astype(np.uint32))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids before each text and all)"""
        body, offsets = flat(texts)
        out, before = [], np.zeros(len(offsets), np.int64)
        total = 0
        for a, b in blocks(body, offsets):
            part = body[a:b]
            if b"<|" not in part.tobytes():  # special tokens' strings count as they are written
                part = LOWER[part]
            texts_here = slice(*np.searchsorted(offsets, [a, b]))
            starts, ends = cuts(part, offsets[texts_here] - a)
            ids, sizes = self.ids.take(self.kept.lookup(part, starts, ends, self._fill))
            after = np.concatenate([[0], np.cumsum(sizes)])
            before[texts_here] = total + after[np.searchsorted(starts, offsets[texts_here] - a)]
            total += len(ids)
            out.append(ids)
        before[np.searchsorted(offsets, len(body)):] = total
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), before


def _tokenised(path: str, end: int, carried: str):
    """(id, number of the row, ids as compressed bytes, how many) of each text, its end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _OPEN:
            _OPEN[path] = WordIds(path)
        words, pack = _OPEN[path], zstandard.ZstdCompressor(level=1)
        wide = "<u2" if max(words.terminals, end + 1) <= 1 << 16 else "<u4"
        last = np.array([end], np.uint32)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                ids, before = words.encode(part.column("text"))
                own = [np.concatenate([ids[a:b], last]).astype(wide) for a, b in zip(before[:-1].tolist(), before[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(carried), part.column("row"), pa.array([pack.compress(x.tobytes()) for x in own], pa.binary()),
                        pa.array([len(x) for x in own], pa.int64()),
                    ],
                    [carried, "row", "packed", "size"],
                )

    return run


def _shards(path: str, end: int, carried: str, kind: pa.DataType, limit: int):
    """Shards of a task's documents, which come in order: a blob, its documents and where each begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _OPEN:
            _OPEN[path] = WordIds(path)
        terminals = max(_OPEN[path].terminals, end + 1)
        wide = "<u2" if terminals <= 1 << 16 else "<u4"
        unpack, part = zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
        names, sizes, ids, held, number = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            grammar = compressed(np.concatenate(ids), terminals)
            starts = np.cumsum([0, *sizes[:-1]])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([held], pa.int64()),
                    pa.array([names], pa.list_(kind)), pa.array([starts], pa.list_(pa.int64())), pa.array([to_bytes(grammar)], pa.binary()),
                ],
                ["part", "number", "ids", "documents", "starts", "grammar"],
            )

        for batch in batches:
            for name, body in zip(batch.column(carried), batch.column("packed")):
                own = np.frombuffer(unpack.decompress(body.as_py()), wide)
                if held and held + len(own) > limit:
                    yield shard()
                    names, sizes, ids, held, number = [], [], [], 0, number + 1
                names.append(name.as_py()), sizes.append(len(own)), ids.append(own)
                held += len(own)
        if held:
            yield shard()

    return run


def write(
    docs: DataFrame, path: str, vocabulary: str, end: int = 2, doc_id: str = "doc_id", shard_ids: int = SHARD_IDS
) -> None:
    """Write the token ids of (doc_id, text) to files below ``path``, documents by ascending doc_id.

    A text's ids come from the tokenizer file ``vocabulary``, then ``end``.  Shards of at most ``shard_ids`` ids (one
    longer document is a shard of its own) are compressed by Re-Pair: rules, expansion lengths and marks (see
    ``repair``) make any range of ids readable without the rest.  Below ``path`` lie ``shards`` (part, number, ids,
    documents, starts, grammar), in order of (part, number), and ``firsts`` (part, number, first): the ids before each shard.

    Texts are tokenised where they are read; only compressed ids are shuffled, once, to ranges of doc_id.  Rows that share
    a doc_id keep the order in which they are read; the row's number is part of the key, so one id on many rows
    is spread like any other.

    Defined results: a null or empty text is the end id alone; null doc_ids come first; repeated rows are written row by row; an
    empty table gives empty files; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType
    name = kind.simpleString()
    read = docs.select(F.col(f"`{doc_id}`").alias("doc"), "text", F.monotonically_increasing_id().alias("row"))
    ids = written(read.mapInArrow(_tokenised(vocabulary, end, "doc"), f"doc {name}, row long, packed binary, size long"), "token-ids")
    total = ids.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // (2 * shard_ids)))
    ordered = ids.select("doc", "row", "packed").repartitionByRange(parts, F.asc_nulls_first("doc"), "row").sortWithinPartitions(
        F.asc_nulls_first("doc"), "row"
    )
    from pyspark.sql.pandas.types import to_arrow_type

    ordered.mapInArrow(
        _shards(vocabulary, end, "doc", to_arrow_type(kind), shard_ids),
        f"part int, number long, ids long, documents array<{name}>, starts array<long>, grammar binary",
    ).write.option("compression", "uncompressed").parquet(f"{path}/shards")
    shards = ids.sparkSession.read.parquet(f"{path}/shards").select("part", "number", "ids")
    firsts(shards).write.parquet(f"{path}/firsts")


def firsts(shards: DataFrame) -> DataFrame:
    """(part, number, first): the ids of all shards before each.

    Sums run within groups of parts, and over the groups' totals: no task sorts more than a group or the list of groups.
    """
    grouped = shards.withColumn("batch", F.floor(F.col("part") / GROUP))
    totals = grouped.groupBy("batch").agg(F.sum("ids").alias("total"))
    span = (Window.unboundedPreceding, -1)
    over_all = Window.orderBy("batch").rowsBetween(*span)
    within = Window.partitionBy("batch").orderBy("part", "number").rowsBetween(*span)
    before = totals.select("batch", F.coalesce(F.sum("total").over(over_all), F.lit(0)).alias("base"))
    own = grouped.select("batch", "part", "number", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("inner"))
    return own.join(before, "batch").select("part", "number", (F.col("base") + F.col("inner")).cast("long").alias("first"))


def _digests(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names, starts = batch.column("documents")[i].values, batch.column("starts")[i].values.to_numpy()
                shard = Shard(batch.column("grammar")[i].as_py())
                sizes = np.diff(np.concatenate([starts, [shard.ids]]))
                crc = []
                step = max(1, BATCH // 4)
                at = 0
                while at < len(starts):  # documents are read a few at a time, by their place among the ids
                    stop = max(at + 1, int(np.searchsorted(starts, starts[at] + step, "left")))
                    last = int(starts[stop]) if stop < len(starts) else shard.ids
                    own = memoryview(shard.read(int(starts[at]), last).astype("<u4").tobytes())
                    base = int(starts[at])
                    for k in range(at, stop):
                        a = 4 * (int(starts[k]) - base)
                        crc.append(zlib.crc32(own[a:a + 4 * int(sizes[k])]))
                    at = stop
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        names.cast(kind), pa.array(np.full(n, batch.column("part")[i].as_py(), np.int32)),
                        pa.array(np.full(n, batch.column("number")[i].as_py(), np.int64)), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "part", "number", "inner", "n_tokens", "ids_crc32"],
                )

    return run


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files: its place and the checksum of its decoded ids."""
    from pyspark.sql.pandas.types import to_arrow_type

    shards = spark.read.parquet(f"{path}/shards")
    kind = shards.schema["documents"].dataType.elementType
    read = shards.mapInArrow(
        _digests(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, part int, number long, inner long, n_tokens long, ids_crc32 long"
    )
    return read.join(spark.read.parquet(f"{path}/firsts"), ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column("grammar")[i].as_py())
            asked = batch.column("asked")[i].as_py()
            found = [shard.read(max(0, a["start"]), max(0, a["stop"])).tolist() for a in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a["name"] for a in asked], pa.int64()), pa.array([a["start"] for a in asked], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                ["name", "start", "ids"],
            )


def read(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """(name, ids) of ranges (name long, start, stop) over all ids of the files; only the rules that cover a range are opened.

    A range is asked of the shards that it meets; its parts are put together in order.  A range outside, or an empty one,
    gives no ids; a null bound gives none either.
    """
    firsts_ = spark.read.parquet(f"{path}/firsts").join(
        spark.read.parquet(f"{path}/shards").select("part", "number", F.col("ids").alias("held")), ["part", "number"]
    )
    met = ranges.select("name", "start", "stop").join(
        firsts_, (F.col("start") < F.col("first") + F.col("held")) & (F.col("stop") > F.col("first"))
    ).groupBy("part", "number").agg(F.collect_list(F.struct(
        "name", (F.col("start") - F.col("first")).alias("start"), (F.col("stop") - F.col("first")).alias("stop"),
    )).alias("asked"))
    parts = spark.read.parquet(f"{path}/shards").select("part", "number", "grammar").join(met, ["part", "number"]).select(
        "grammar", "asked"
    ).mapInArrow(_ranges, "name long, start long, ids array<long>")
    joined = parts.groupBy("name").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("start")).alias("at"), "ids"))), lambda x: x["ids"]
    )).alias("ids"))
    return ranges.select("name").join(joined, "name", "left").select("name", F.coalesce("ids", F.array().cast("array<long>")).alias("ids"))


def round_trip(docs: DataFrame, vocabulary: str, end: int = 2, path: str | None = None) -> DataFrame:
    """``write``, then ``digests`` of what the files hold."""
    path = path or shared_path(docs.sparkSession, "token-files")
    write(docs, path, vocabulary, end)
    return digests(docs.sparkSession, path)
