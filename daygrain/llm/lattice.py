"""Document probabilities under a subword lattice: every segmentation of every word counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.text import LOWER, SPACE, flat, mixed, pieces, word_hashes, word_spans
from daygrain.session import written

SHARD_BYTES = 32 << 20
START = "▁"  # the vocabulary marks the beginning of a word
LN10 = float(np.log(10))


def _packed(numbers: list[np.ndarray]) -> bytes:
    """Word numbers, byte plane by byte plane, compressed."""
    whole = np.concatenate(numbers) if numbers else np.zeros(0, np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(whole.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _shards(doc_type: pa.DataType):
    """One row a shard: its distinct words, how often training documents have each, and each document's words by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = itertools.count(TaskContext.get().partitionId() << 32)
        fresh = lambda: {"known": {}, "words": [], "counts": np.zeros(1 << 12, np.int64), "numbers": [], "docs": [], "held": [], "sizes": [], "bytes": 0}
        state = fresh()

        def out():
            n = len(state["words"])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([next(serial)], pa.int64()), pa.array([state["words"]], pa.list_(pa.binary())),
                    pa.array([state["counts"][:n]], pa.list_(pa.int64())), pa.array([state["docs"]], pa.list_(doc_type)),
                    pa.array([state["held"]], pa.list_(pa.bool_())), pa.array([state["sizes"]], pa.list_(pa.int64())),
                    pa.array([_packed(state["numbers"])], pa.binary()),
                ],
                ["shard", "words", "counts", "docs", "held", "sizes", "numbers"],
            )

        for batch in batches:
            for part in pieces(batch):
                body, offsets = flat(part.column("text"))
                body = LOWER[body]
                starts, ends, bounds = word_spans(body, offsets, SPACE)
                names, at, inverse = np.unique(word_hashes(body, starts, ends), return_index=True, return_inverse=True)
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                known, words, raw = state["known"], state["words"], body.tobytes()
                number = np.empty(len(names), np.int64)
                for i, (name, k) in enumerate(zip(names.tolist(), at.tolist())):
                    got = known.get(name)
                    if got is None:
                        got = known[name] = len(words)
                        words.append(raw[starts[k]:ends[k]])
                    number[i] = got
                while len(words) > len(state["counts"]):
                    state["counts"] = np.concatenate([state["counts"], np.zeros_like(state["counts"])])
                numbers = number[inverse]
                learns = ~np.repeat(held, np.diff(bounds))
                state["counts"] += np.bincount(numbers[learns], minlength=len(state["counts"]))
                state["numbers"].append(numbers.astype(np.uint32))
                state["docs"] += part.column("doc_id").to_pylist()
                state["held"] += held.tolist()
                state["sizes"] += np.diff(bounds).tolist()
                state["bytes"] += len(body)
                if state["bytes"] >= SHARD_BYTES:
                    yield out()
                    state = fresh()
        if state["docs"]:
            yield out()

    return run


@dataclass
class Lattice:
    """Log probabilities of the vocabulary's pieces, by the hash of their bytes."""

    names: np.ndarray
    scores: np.ndarray
    byte: np.ndarray
    longest: int

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.names >> np.uint64(44)).astype(np.int64)] = True

    def words(self, words: list[bytes]) -> np.ndarray:
        """The log probability of each word: the sum over all segmentations into pieces, byte pieces included."""
        out = np.empty(len(words))
        mark = START.encode()
        sizes = np.array([len(w) + len(mark) for w in words], np.int64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(1, (1 << 18) // size)
            for i in range(0, len(rows), step):
                own = rows[i:i + step]
                out[own] = self._forward(np.frombuffer(b"".join(mark + words[r] for r in own.tolist()), np.uint8).reshape(len(own), size))
        return out

    def _forward(self, body: np.ndarray) -> np.ndarray:
        n, size = body.shape
        reach = min(self.longest, size)
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0
        # hashes of all strings that end at a place, grown by one byte to the left at a time
        for end in range(1, size + 1):
            alpha[end] = alpha[end - 1] + self.byte[body[:, end - 1]]
            grown = np.zeros(n, np.uint64)
            for k in range(1, min(reach, end) + 1):
                grown = grown * _GROW + _LETTER[body[:, end - k]]
                key = mixed(grown + np.uint64(k))
                hit = np.flatnonzero(self.maybe[(key >> np.uint64(44)).astype(np.int64)])
                if not len(hit):
                    continue
                at = np.minimum(np.searchsorted(self.names, key[hit]), len(self.names) - 1)
                good = self.names[at] == key[hit]
                hit, at = hit[good], at[good]
                alpha[end, hit] = np.logaddexp(alpha[end, hit], alpha[end - k, hit] + self.scores[at])
        return alpha[size]


_GROW = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.random.default_rng(4242).integers(1, 1 << 63, 256, dtype=np.uint64)


def _name(piece: bytes) -> int:
    grown = np.zeros(1, np.uint64)
    for byte in reversed(piece):
        grown = grown * _GROW + _LETTER[byte]
    return int(mixed(grown + np.uint64(len(piece)))[0])


def vocabulary(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def lattice(model: str, counts: dict[int, float]) -> Lattice:
    """The existing vocabulary with unigram scores from counts of its pieces, half a count added to each."""
    sp = vocabulary(model)
    size = sp.get_piece_size()
    usable = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    total = sum(counts.get(i, 0) + 0.5 for i in usable)
    byte, names, scores, longest = np.full(256, np.log(0.5 / total)), [], [], 1
    for i in usable:
        score = np.log((counts.get(i, 0) + 0.5) / total)
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte[int(piece[3:-1], 16)] = score
            continue
        raw = piece.encode()
        names.append(_name(raw)), scores.append(score)
        longest = max(longest, len(raw))
    order = np.argsort(np.array(names, np.uint64))
    return Lattice(np.array(names, np.uint64)[order], np.array(scores)[order], byte, longest)


def _piece_counts(model: str):
    def run(batches):
        sp = vocabulary(model)
        sums = np.zeros(sp.get_piece_size())
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            found = sp.encode(words, num_threads=1)
            weights = np.repeat(batch.column("c").to_numpy(), [len(f) for f in found])
            ids = np.fromiter(itertools.chain.from_iterable(found), np.int64)
            sums += np.bincount(ids, weights=weights, minlength=len(sums))
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], ["piece", "n"])

    return run


def _word_scores(model: Lattice):
    def run(batches):
        for batch in batches:
            yield batch.append_column("inner", pa.array(model.words(batch.column("word").to_pylist())))

    return run


def _scored(total: int, types: int, ends: int, unseen: float):
    floor = total + 0.5 * (types + 1)

    def run(key, shard, facts):
        if not shard.num_rows:
            return pa.table({n: pa.array([], t) for n, t in _columns(shard.schema.field("docs").type.value_type)})
        row = {c: shard.column(c)[0] for c in shard.column_names}
        held = np.array(row["held"].values.to_pylist(), bool)
        sizes = row["sizes"].values.to_numpy()
        size = facts.num_rows
        c, inner = np.zeros(size, np.int64), np.zeros(size)
        at = facts.column("at").to_numpy()
        c[at], inner[at] = facts.column("c").to_numpy(), facts.column("inner").to_numpy()
        base = np.log10((c + 0.5) / floor)
        known = np.log(np.maximum(c, 1) / max(total, 1)) + np.log1p(-unseen)
        whole = np.logaddexp(np.where(c > 0, known, -np.inf), inner + np.log(unseen)) / LN10
        numbers = _unpacked(row["numbers"].as_py())
        after = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])

        def summed(values):
            out = np.zeros(len(sizes))
            for i, (a, b) in enumerate(zip(after[:-1].tolist(), after[1:].tolist())):
                out[i] = values[numbers[a:b]].sum()
            return out

        end_base = np.log10((ends + 0.5) / floor)
        end = (np.log(ends / total) + np.log1p(-unseen)) / LN10 if ends else np.log10(unseen)
        columns = [
            row["docs"].values, pa.array(held), pa.array(sizes + 1), pa.array((summed((c > 0).astype(float))).astype(np.int64) + int(ends > 0)),
            pa.array(np.full(len(sizes), total, np.int64)), pa.array(summed(base) + end_base), pa.array(summed(whole) + end),
        ]
        return pa.table(columns, names=[n for n, _ in _columns(None)])

    return run


def _columns(doc_type):
    return [
        ("doc_id", doc_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]


def document_scores(docs: DataFrame, model: str, folds: int = 5, held_out: int = 1) -> DataFrame:
    """log10 probabilities of documents (doc_id, text) under a word model and a subword lattice learnt from most of them.

    Returns doc_id, held_out (crc32 of the doc_id as text, modulo ``folds``, is ``held_out``; such rows teach
    nothing), n_tokens, n_known, train_tokens, base_score and score.  Tokens are the words between white space, A-Z in
    lower case, and one end.  base_score adds half a count to each training token and one unknown one.

    score: a word is one of the training words, or any sequence of pieces of the existing vocabulary file ``model``
    (sentencepiece); its probability is the sum over both and over all segmentations, by forward recursion in log
    space: ``(1 - u) c / N + u * lattice``, where u is the share of training tokens seen once.  Bytes are pieces, too,
    so every word has a probability.  Piece scores are unigram counts over the training words.

    Texts are read once.  Each shard (32 MB of text at most, plus one row) becomes its distinct words and numbers
    into them; only distinct words of shards are shuffled, summed and joined back, so a frequent word is one row a
    shard.  The vocabulary stays distributed; the driver sees totals and the piece counts.  Defined results: a null
    or empty text is its end alone; a null doc_id teaches; repeated rows are scored row by row; without training
    tokens every score is that of unknown words; an empty table gives no rows.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    rows = docs.select("doc_id", "text", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    shards = written(
        rows.mapInArrow(
            _shards(to_arrow_type(docs.schema["doc_id"].dataType)),
            f"shard long, words array<binary>, counts array<long>, docs array<{kind}>, held array<boolean>, sizes array<long>, numbers binary",
        ),
        "lm-shards",
    )
    listed = shards.select("shard", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "entry")).select(
        "shard", "at", F.col("entry.words").alias("word"), F.col("entry.counts").alias("c")
    )
    vocabulary_table = written(listed.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    ends = shards.select(F.explode("held").alias("h")).where("NOT h").count()
    sums = vocabulary_table.where("c > 0").agg(F.sum("c"), F.count("*"), F.sum((F.col("c") == 1).cast("long"))).first()
    total, types, once = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0), sums[2] or 0
    unseen = (once + 1) / (total + 2)
    learnt = vocabulary_table.where("c > 0").mapInArrow(_piece_counts(model), "piece int, n double")
    counts = {r["piece"]: r["n"] for r in learnt.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    scored = vocabulary_table.mapInArrow(_word_scores(lattice(model, counts)), "word binary, c long, inner double")
    facts = listed.select("shard", "at", "word").join(scored, "word").select(F.col("shard").alias("of"), "at", "c", "inner")
    return shards.groupBy("shard").cogroup(facts.groupBy("of")).applyInArrow(
        _scored(total, types, ends, unseen),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
