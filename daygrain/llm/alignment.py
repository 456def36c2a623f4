"""Alignment of two tokenizers' tokens by pointer jumping, and how often two tokens meet in the corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.slots import BLOCK, Kept, Runs, Slots, byte_of_sign, flattened, in_signs, interleaved, whole_words
from daygrain.llm.text import flat, give_back, mixed, pieces
from daygrain.session import written

SLICE = 4 << 20  # bytes of text whose documents share one row of pair counts
PAIRS = 1 << 21  # distinct pairs a worker keeps
CHUNKS = 1 << 19  # distinct chunks a worker keeps

_OPEN: dict[tuple[str, str], "Aligner"] = {}
_EMPTY = hashlib.sha256(b"").hexdigest()


def terminals(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The last token of the second kind in the group of each token, first kind before second.

    ``first`` and ``second`` are the ends of the tokens of two kinds that cover the same bytes.  Every token points to the
    farthest-right token that overlaps it: of two that end together the one of the second kind.  A token of the
    second kind that nothing reaches beyond points to itself.  All successors are doubled at once until none changes.
    """
    starts_a, starts_b = np.concatenate([[0], first[:-1]]), np.concatenate([[0], second[:-1]])
    over = np.searchsorted(starts_b, first, "left") - 1 + len(first)
    back = np.searchsorted(starts_a, second, "left") - 1
    own = np.arange(len(second)) + len(first)
    succ = np.concatenate([over, np.where(first[back] > second, back, own) if len(first) else own])
    while True:
        far = succ[succ]
        if (far == succ).all():
            return succ - len(first)
        succ = far


def chunk_starts(body: np.ndarray, offsets: np.ndarray, marks: str = "") -> np.ndarray:
    """Where a text begins, a space follows something that is surely no white space, or a mark an ASCII letter or digit."""
    before = np.concatenate([[0x20], body[:-1]]).astype(np.uint8)
    second = np.concatenate([[0x20] * 2, body[:-2]])[:len(body)].astype(np.uint8)
    third = np.concatenate([[0x20] * 3, body[:-3]])[:len(body)].astype(np.uint8)
    start = (body == 0x20) & (before > 0x20) & (before != 0x7F)
    high = np.flatnonzero(start & (before >= 0x80))
    if len(high):
        a, b, c = third[high].astype(int), second[high].astype(int), before[high].astype(int)
        # U+0085, U+00A0, U+1680, U+180E, U+2000 to U+206F, U+2581, U+3000, U+FEFF
        space = ((b == 0xC2) & ((c == 0x85) | (c == 0xA0))) | ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E))))
        space |= (a == 0xE2) & ((b == 0x80) | (b == 0x81) | (b == 0x96)) | ((a == 0xE3) & (b == 0x80)) | ((a == 0xEF) & (b == 0xBB))
        start[high[space]] = False
    if marks:
        start |= _flags(marks.encode())[body] & _ALNUM[before]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(start)


def _flags(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


_ALNUM = _flags(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_MARKS = ",.;:!?"


class Aligner:
    """Tokens of both vocabularies for chunks of text, their groups and the pairs that share one.

    A chunk is a run of white space with what follows, up to the next space after something else, or to a mark after a
    letter or digit.  Neither tokenizer joins bytes across chunks: the byte vocabulary's splitter attaches a space to what
    comes after it and parts letters from marks; no piece of the other vocabulary has its space sign behind another sign
    (else whole texts are chunks), and none has a mark behind a letter or digit (else that mark begins no chunk).
    """

    def __init__(self, a: str, b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        self.bare = Tokenizer(self.a.model)  # takes words in the vocabulary's own signs
        signs = byte_of_sign()
        entries = {i: t for t, i in self.a.get_vocab().items()}
        tokens = [bytes(signs.get(c, 0x3F) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.bytes_a = self._of(tokens)
        pieces_ = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = self._of([
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces_)
        ])
        self.apart = not any(re.search("[^▁]▁", p) for p in pieces_)
        inner = {q for i, p in enumerate(pieces_) if not self.b.is_byte(i) for p_, q in zip(p, p[1:]) if p_.isascii() and p_.isalnum()}
        self.marks = "".join(m for m in _MARKS if m not in inner) if self.apart and not any("\n" in p for p in pieces_) else ""
        self.space = self.b.piece_to_id("▁")
        self.digits = self._of([b"%d," % i for i in range(max(len(tokens), len(pieces_)))])
        # nA, nB, groups, links and whether the bytes differ; the groups as text; times linked << 32 | number of the pair
        self.facts, self.text, self.pairs = Runs(np.int64), Runs(np.uint8), Runs(np.int64)
        self.kept = Kept(self.facts, self.text, self.pairs, kept=CHUNKS)
        self.known, self.names = Slots(), Runs(np.int64)

    @staticmethod
    def _of(tokens: list[bytes]) -> Runs:
        out = Runs(np.uint8)
        out.append(np.array([len(t) for t in tokens], np.int64), np.frombuffer(b"".join(tokens), np.uint8))
        return out

    def trimmed(self, most: int | None = None) -> None:
        """Forget chunks and pairs if there are too many (None: ``PAIRS``); numbers of pairs hold between two calls."""
        if self.known.used > (PAIRS if most is None else most):
            self.known.clear(), self.names.clear(), self.kept.slots.clear()
            for run in self.kept.runs:
                run.clear()

    def fill(self, chunks: list[bytes]) -> None:
        for i in range(0, len(chunks), 8192):
            self._fill(chunks[i:i + 8192])

    def _fill(self, chunks: list[bytes]) -> None:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        # a space and letters are one word to the splitter; of letters, those up to U+024F
        plain = np.array([t[0] == " " and t[1:].isalpha() and max(t) <= "\u024f" for t in texts])
        easy = whole_words(self.bare, in_signs([chunks[k] for k in np.flatnonzero(plain).tolist()]))
        hard = self.a.encode_batch_fast([texts[k] for k in np.flatnonzero(~plain).tolist()], add_special_tokens=False)
        ids_a, size_a = interleaved(plain, easy, flattened([e.ids for e in hard]))
        # without its first space, which the encoder adds; what has none comes behind a line end, which joins nothing
        found_b = self.b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        found_b = [ids or [self.space] if t[0] == " " else ids[2:] for t, ids in zip(texts, found_b)]
        n = len(chunks)
        ids_b, size_b = flattened(found_b)
        chunk_a, chunk_b = np.repeat(np.arange(n), size_a), np.repeat(np.arange(n), size_b)
        good = self._same(chunks, self.bytes_a, ids_a, chunk_a) & self._same(chunks, self.bytes_b, ids_b, chunk_b)
        keep_a, keep_b = good[chunk_a], good[chunk_b]
        ids_a, chunk_a, ids_b, chunk_b = ids_a[keep_a], chunk_a[keep_a], ids_b[keep_b], chunk_b[keep_b]
        # all chunks in a row: both kinds of tokens end together where a chunk ends
        last = terminals(np.cumsum(self.bytes_a.size[ids_a]), np.cumsum(self.bytes_b.size[ids_b]))
        ends = np.unique(last[len(ids_a):])
        group_a, group_b = np.searchsorted(ends, last[:len(ids_a)]), np.searchsorted(ends, last[len(ids_a):])
        chunk_of = chunk_b[ends]
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        per_chunk = [
            np.bincount(chunk_a, minlength=n), np.bincount(chunk_b, minlength=n), np.bincount(chunk_of, minlength=n),
            np.bincount(chunk_of, weights=in_a * in_b, minlength=n).astype(np.int64), ~good,
        ]
        self.facts.append(np.full(n, 5), np.stack(per_chunk, axis=1).astype(np.int64).reshape(-1))
        self._append_text(n, ids_a, group_a, ids_b, group_b, chunk_of)
        self._append_pairs(n, ids_a, group_a, ids_b, group_b, chunk_of)

    @staticmethod
    def _same(chunks: list[bytes], table: Runs, ids: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Whether the tokens' bytes in a row are those of each chunk."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        good = np.bincount(chunk, weights=table.size[ids], minlength=len(chunks)).astype(np.int64) == sizes
        made, _ = table.take(ids[good[chunk]])
        wanted = np.frombuffer(b"".join(c for c, g in zip(chunks, good) if g), np.uint8)
        wrong = np.flatnonzero(made != wanted)
        if len(wrong):
            places = np.flatnonzero(good)
            good[places[np.unique(np.searchsorted(np.cumsum(sizes[places]), wrong, "right"))]] = False
        return good

    def _append_text(self, n, ids_a, group_a, ids_b, group_b, chunk_of) -> None:
        """``a1,a2|b1;`` of each group of each chunk."""
        ids = np.concatenate([ids_a, ids_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        ids, kind = ids[order], np.concatenate([2 * group_a, 2 * group_b + 1])[order]
        body, sizes = self.digits.take(ids)
        ends = np.cumsum(sizes) - 1
        changes = np.concatenate([kind[1:] != kind[:-1], [True]]) if len(kind) else np.zeros(0, bool)
        body[ends[changes & (kind % 2 == 0)]] = ord("|")
        body[ends[changes & (kind % 2 == 1)]] = ord(";")
        self.text.append(np.bincount(chunk_of[kind // 2], weights=sizes, minlength=n).astype(np.int64), body)

    def _append_pairs(self, n, ids_a, group_a, ids_b, group_b, chunk_of) -> None:
        """Pairs of ids that share a group, with how many of their occurrences do; equal ids of a group are one first."""
        a, times_a = np.unique((group_a << 32) | ids_a, return_counts=True)
        b, times_b = np.unique((group_b << 32) | ids_b, return_counts=True)
        of_a, of_b = a >> 32, b >> 32
        wide = np.bincount(of_b, minlength=len(chunk_of))  # distinct ids of the second kind in each group
        first = np.cumsum(wide) - wide
        many = wide[of_a]
        after = np.cumsum(many)
        i = np.repeat(np.arange(len(a)), many)
        j = np.arange(int(after[-1]) if len(after) else 0) + np.repeat(first[of_a] - (after - many), many)
        names = ((a[i] & 0xFFFFFFFF) << 32) | (b[j] & 0xFFFFFFFF)
        own = np.unique(names)
        hashes = mixed(own.astype(np.uint64))
        new = self.known.find(hashes) < 0
        self.known.add(hashes[new])
        self.names.append(np.ones(int(new.sum()), np.int64), own[new])
        number = self.known.find(hashes)[np.searchsorted(own, names)]
        key, at = np.unique((chunk_of[of_a[i]] << 32) | number, return_inverse=True)
        times = np.bincount(at, weights=times_a[i] * times_b[j], minlength=len(key))
        sizes = np.bincount(key >> 32, minlength=n)
        self.pairs.append(sizes, (np.minimum(times, 2**31 - 1).astype(np.int64) << 32) | (key & 0xFFFFFFFF))

    def documents(self, texts: pa.Array):
        """Facts (nA, nB, groups, links) and groups' text of each text, and (text, pair, weight) of all, pairs once a text."""
        texts = pc.fill_null(texts, "")
        full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        body, offsets = flat(pc.if_else(pa.array(full), pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)), texts))
        starts = chunk_starts(body, offsets, self.marks) if self.apart else offsets[:-1][np.diff(offsets) > 0]
        ends = np.append(starts[1:], len(body)).astype(np.int64)
        owner = np.searchsorted(offsets, starts, "right") - 1
        facts, texts_out, keys, weights = np.zeros((len(full), 5), np.int64), [[] for _ in full], [], []
        at = 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
            a, b = int(starts[at]), int(ends[stop - 1])
            slots = self.kept.lookup(body[a:b], starts[at:stop] - a, ends[at:stop] - a, self.fill)
            mine = owner[at:stop]
            edge = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            facts[mine[edge]] += np.add.reduceat(self.facts.body[:5 * self.facts.count].reshape(-1, 5)[slots], edge)
            signs, sizes = self.text.take(slots)
            signs, after = signs.tobytes(), np.concatenate([[0], np.cumsum(sizes)])
            for k, (x, y) in enumerate(zip(edge, [*edge[1:], len(mine)])):
                texts_out[mine[edge[k]]].append(signs[after[x]:after[y]])
            pairs, many = self.pairs.take(slots)
            keys.append((np.repeat(mine, many) << 32) | (pairs & 0xFFFFFFFF))
            weights.append((pairs >> 32).astype(np.int32))
            at = stop
        facts[facts[:, 4] > 0] = 0
        key, weight = _added(keys, weights)
        sound = facts[key >> 32, 0] > 0
        return facts, texts_out, key[sound], weight[sound]


def _added(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their weights."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, weight = np.concatenate(keys), np.concatenate(weights).astype(np.int64)
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[edge], np.add.reduceat(weight, edge) if len(edge) else weight


def _opened(a: str, b: str) -> Aligner:
    if (a, b) not in _OPEN:
        _OPEN[a, b] = Aligner(a, b)
    return _OPEN[a, b]


_META = "n_a long, n_b long, n_groups long, n_links long"


def _read(a: str, b: str, with_text: bool):
    """A row for each slice of documents: their facts, the slice's pairs and how many of its documents hold each, and
    which document holds which pair how often (sparse, compressed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pack = _opened(a, b), zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch, limit=SLICE):
                aligner.trimmed()
                facts, texts, key, weight = aligner.documents(part.column("text"))
                sound = (facts[:, 0] > 0).tolist()
                whole = [b"".join(t)[:-1] if s else b"" for t, s in zip(texts, sound)]
                flags = np.zeros(aligner.known.used, bool)
                flags[key & 0xFFFFFFFF] = True
                here = np.cumsum(flags) - 1
                local = here[key & 0xFFFFFFFF]
                names = aligner.names.body[:aligner.known.used][flags]
                bounds = np.searchsorted(key >> 32, np.arange(len(whole) + 1))
                told = [t.decode() for t in whole] if with_text else [hashlib.sha256(t).hexdigest() if s else "" for t, s in zip(whole, sound)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()), pa.array([part.column("doc").to_pylist()], pa.list_(part.schema.field("doc").type)),
                        *[pa.array([facts[:, i]], pa.list_(pa.int64())) for i in range(4)], pa.array([told], pa.list_(pa.string())),
                        pa.array([names], pa.list_(pa.int64())), pa.array([np.bincount(local, minlength=len(names))], pa.list_(pa.int64())),
                        pa.array([pack.compress(x.tobytes()) for x in (bounds.astype("<i8"),)], pa.binary()),
                        pa.array([pack.compress(local.astype("<u4").tobytes())], pa.binary()),
                        pa.array([pack.compress(weight.astype("<i8").tobytes())], pa.binary()),
                    ],
                    ["slice", "doc", "n_a", "n_b", "n_groups", "n_links", "told", "pairs", "docs", "bounds", "local", "weights"],
                )
                number += 1
        aligner.trimmed(-1)  # a worker that waits for its next task holds nothing
        give_back()

    return run


def _scored(slices: pa.Table, counted: pa.Table) -> pa.Table:
    """Documents of one slice with the corpus-wide counts of its pairs."""
    unpack = zstandard.ZstdDecompressor()
    count, best = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, np.int64)
    at = counted.column("at").to_numpy()
    count[at], best[at] = counted.column("count").to_numpy(), counted.column("best").to_numpy().astype(np.int64)
    out = []
    for row in range(slices.num_rows):
        one = {c: slices.column(c)[row] for c in slices.column_names}
        bounds, local, weight = (
            np.frombuffer(unpack.decompress(one[c].as_py()), kind).astype(np.int64) for c, kind in (("bounds", "<i8"), ("local", "<u4"), ("weights", "<i8"))
        )
        sums = [np.concatenate([[0], np.cumsum(weight * x[local])]) if len(count) else np.zeros(len(local) + 1, np.int64) for x in (best, count)]
        n_best, count_sum = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
        out.append(pa.table({
            "doc": one["doc"].values, **{c: one[c].values for c in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "told": one["told"].values,
        }))
    return pa.concat_tables(out)


def pair_counts(slices: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold a pair linked, and whether no pair of its first id is in more."""
    counts = slices.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.docs").alias("count")
    )
    of_first = Window.partitionBy(F.shiftright("pair", 32))  # at most as many rows as the second vocabulary has ids
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(of_first)).alias("best"))


def aligned(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Tokens of two vocabularies of each document (doc_id, text), in groups of tokens that overlap.

    ``a`` is a byte-level vocabulary file of the tokenizers library, ``b`` a piece vocabulary of sentencepiece.  Both
    cover a space and the text; a group ends where tokens of both end.  Every token points to the farthest-right token that
    overlaps it, and doubling the successors leads each to the last token of its group (``terminals``).  Chunks of text
    between which no token reaches are aligned once by a worker, wherever they occur.

    Returns doc_id, n_a, n_b, n_groups, n_links (pairs of token occurrences that share a group), n_best (links whose pair of
    ids is linked in as many documents as any pair of its first id), count_sum (over links: documents in which the
    pair is linked) and groups_sha256 of ``a1,a2|b1;a3|b2,b3``, or with ``with_text`` that text as ``groups``.

    Pairs travel once for each slice of about 4 MB of text, with the number of its documents that hold them; the counts
    return to the slices, where documents are added up.  No table grows with the links, and no pair's documents meet.

    Defined results: a text that is null, empty, or whose tokens' bytes are not those of a space and the text has zeros and
    an empty last column; strings of special tokens are plain text; null and repeated doc_ids are answered row by
    row, each row a document; an empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    lists = ", ".join(f"{c.split()[0]} array<long>" for c in _META.split(", "))
    read = docs.select(F.col(f"`{doc_id}`").alias("doc"), "text")
    slices = written(read.mapInArrow(
        _read(a, b, with_text),
        f"slice long, doc array<{kind}>, {lists}, told array<string>, pairs array<long>, docs array<long>, bounds binary, local binary, weights binary",
    ), "token-slices")
    counts = pair_counts(slices)
    asked = slices.select("slice", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair").select(
        F.col("slice").alias("of"), "at", "count", "best"
    )
    told = slices.select("slice", "doc", "n_a", "n_b", "n_groups", "n_links", "told", "bounds", "local", "weights")
    scored = told.groupBy("slice").cogroup(asked.groupBy("of")).applyInArrow(
        _scored, f"doc {kind}, {_META}, n_best long, count_sum long, told string"
    )
    last = "groups" if with_text else "groups_sha256"
    return scored.select(F.col("doc").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("told").alias(last))


def groups(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, position, a, b): the ids of both vocabularies in each group of each document, in order from 0."""
    told = aligned(docs, a, b, doc_id, with_text=True).where("groups <> ''")
    sides = told.select(doc_id, F.posexplode(F.split("groups", ";")).alias("position", "both")).select(
        doc_id, "position", F.split("both", r"\|").alias("sides")
    )
    ids = (F.transform(F.split(F.col("sides")[i], ","), lambda x: x.cast("int")).alias(n) for i, n in enumerate("ab"))
    return sides.select(doc_id, "position", *ids)
