"""Alignment of the tokens of two tokenizers, with inverted pair bitmaps for the corpus statistics.

Each text, with a blank in front, is encoded by a byte-level BPE (A) and a SentencePiece BPE (B).  Byte offsets at which a
token of both ends cut the text into groups; every A token of a group is linked with every B token of it.

The index is inverted: documents are dealt into containers (consecutive rows of a task, at most DOCS of them and about
BYTES of text) and get a number in it.  A pair of ids has, per container, one bitmap of the documents that hold the
pair linked, and multiplicity planes beside it: plane j, from 1, marks the documents whose number of links less one
has bit j - 1 set.  The batches of a container are OR-merged before a bitmap is written, as sorted numbers or as bits,
whichever is shorter.  Bitmaps of one pair in different containers share no document, so their union's population is
the sum of theirs: a pair's document count is the sum over the first planes, its link count the sum over all planes,
each weighed by its power of two.  A count is the same for all documents of a posting, so the postings carry it back:
joined with their pair's count they go to their container, where each plane adds its weight to its documents.

A batch of about 1 MiB of text is aligned at once over flat arrays; a task holds the pairs of one container.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from blank + text, have no tokens
(zeros and an empty ``groups``); ids may be null or repeat, each row is a document; other columns are never read;
an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Workspace, batches
from .tokens import _BYTE_CHARS

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
#: Documents of a container and bytes of text (a longer text is a container of its own).
DOCS, BYTES = 8192, 8 << 20
#: The file's split into words that the pattern of the public rank files gives, too.
PLAIN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
#: Runs for which the rank library's merges may take time beyond proportion.
_LONG = re.compile(r"\S{4096}|\s{4096}")
#: Bits of a document's number in its container.
DOC_BITS = 16
#: Links of a group beyond which equal tokens are counted before they are linked.
WIDE = 4096


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        path_a = path_a or public_tokenizers.path(MODEL_A)
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.ranks = None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path(MODEL_B))
        byte_of = {c: b for b, c in enumerate(_BYTE_CHARS)}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b = [bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()
                        for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        if (spec["normalizer"] is None and spec["pre_tokenizer"] == PLAIN_SPLIT
                and [vocabulary[x + y] for x, y in pairs] == list(range(256, 256 + len(pairs)))):
            # merges in the order of their ids: the faster library with the file's tokens as ranks gives the same ids
            ranks = {self.bytes_a[i]: i for i in range(256 + len(pairs))}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens={})
        self.size_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.size_b = np.array([len(b) for b in self.bytes_b], np.int64)
        #: Bits of a document's number and of a B id in a link's key.
        self.bits_b = (len(self.bytes_b) - 1).bit_length()
        if (len(self.bytes_a) - 1).bit_length() + self.bits_b > 63 - DOC_BITS:
            raise ValueError("vocabularies too large for the keys of links")

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text by A and B; none where a tokenizer does not give the bytes of blank + text back."""
        full = [" " + t if t else "" for t in texts]
        left = [self.ranks.encode_ordinary(t) if self.ranks and not _LONG.search(t) else
                self.a.encode(t, add_special_tokens=False).ids for t in full]
        right = self.b.encode([t or "" for t in texts], num_threads=1)
        for i, text in enumerate(full):
            raw = text.encode()
            if (b"".join(map(self.bytes_a.__getitem__, left[i])) != raw
                    or b"".join(map(self.bytes_b.__getitem__, right[i])) != raw):
                left[i], right[i] = [], []
        return left, right

    def align(self, texts: list[str | None]):
        """(numbers, groups, keys, links) of a batch: per text its numbers of A tokens, B tokens, groups and links, its
        groups as text, and every id pair that a text holds linked, as ascending keys
        (A id, B id, place of the text), with how often it does."""
        left, right = self.encode(texts)
        size = np.array([[len(x) for x in left], [len(x) for x in right]], np.int64)
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, n) for x, n in zip((left, right), size.sum(axis=1).tolist()))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # both cover the same bytes of each text, so one running count serves all texts, and a text's end is a cut
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        text_of = np.repeat(np.arange(len(texts)), size[0])[np.cumsum(in_a) - 1] if len(cuts) else cuts
        numbers = np.stack([size[0], size[1], np.bincount(text_of, minlength=len(texts)),
                            np.bincount(text_of, in_a * in_b, len(texts)).astype(np.int64)], axis=1)
        keys, links = self._links(a, b, group_a, in_a, in_b, text_of)
        return numbers, self._groups(a, b, in_a, in_b, numbers[:, 2]), keys, links

    def _links(self, a, b, group_a, in_a, in_b, text_of):
        first_b = np.cumsum(in_b) - in_b
        narrow = in_a * in_b <= WIDE
        chosen = np.flatnonzero(narrow[group_a])
        group = group_a[chosen]
        times = in_b[group]
        owner = np.repeat(np.arange(len(group)), times)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
        keys, links = np.unique(self._key(a[chosen][owner], b[(first_b[group])[owner] + place], text_of[group][owner]),
                                return_counts=True)
        found = [(keys, links.astype(np.int64))]
        first_a = np.cumsum(in_a) - in_a
        for g in np.flatnonzero(~narrow):
            x, n = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, m = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            found.append((self._key(x[:, None], y[None, :], text_of[g]).ravel(), np.outer(n, m).ravel()))
        return merge(found)

    def _key(self, a, b, text):
        return (a << self.bits_b | b) << DOC_BITS | text

    @staticmethod
    def _groups(a, b, in_a, in_b, per_text) -> pa.Array:
        def lists(sizes, values):
            return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64()), values)
        text, comma, bar, semicolon = pa.large_string(), *(pa.scalar(c, pa.large_string()) for c in ",|;")
        sides = [pc.binary_join(lists(n, pc.cast(pa.array(x), text)), comma) for n, x in ((in_a, a), (in_b, b))]
        return pc.binary_join(lists(per_text, pc.binary_join_element_wise(*sides, bar)), semicolon)


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner_of(path_a: str | None, path_b: str | None) -> Aligner:
    """The aligner of this worker, loaded once for all tasks that it runs."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def merge(parts: list[tuple[np.ndarray, np.ndarray]]):
    """Keys in ascending order, each once, with the sum of its links."""
    if len(parts) == 1:
        return parts[0]
    keys, links = (np.concatenate([p[i] for p in parts]) for i in range(2))
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    if len(keys):
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, links = keys[first], np.add.reduceat(links, first)
    return keys, links


def posting(pair: np.ndarray, doc: np.ndarray, docs: int):
    """One bitmap per pair: (pair, population, dense, bits); ``pair`` ascends."""
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    count = np.diff(np.r_[first, len(pair)])
    width = -(-docs // 8)
    dense = 2 * count > width
    offset = np.r_[0, np.cumsum(np.where(dense, width, 2 * count))]
    data = np.zeros(int(offset[-1]), np.uint8)
    owner = np.repeat(np.arange(len(first)), count)
    thin = np.flatnonzero(~dense[owner])
    at = (offset[owner] + 2 * (np.arange(len(pair)) - first[owner]))[thin]
    data[at], data[at + 1] = doc[thin] & 255, doc[thin] >> 8
    thick = np.flatnonzero(dense[owner])
    np.bitwise_or.at(data, offset[owner[thick]] + (doc[thick] >> 3), (1 << (doc[thick] & 7)).astype(np.uint8))
    bits = pa.Array.from_buffers(pa.binary(), len(first),
                                 [None, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data)])
    return pair[first], count, dense, bits


def documents_of(dense: np.ndarray, bits: pa.Array):
    """(row, document) of every document marked in the bitmaps."""
    offset = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1].astype(np.int64)
    data = np.frombuffer(bits.buffers()[2], np.uint8)
    size = np.diff(offset)
    thin = np.flatnonzero(~dense)
    rows, docs = [np.repeat(thin, size[thin] // 2)], []
    begin = np.repeat(offset[thin] - np.r_[0, np.cumsum(size[thin])[:-1]], size[thin]) if len(thin) else None
    raw = data[begin + np.arange(int(size[thin].sum()))] if len(thin) else np.zeros(0, np.uint8)
    docs.append(raw[::2].astype(np.int64) | raw[1::2].astype(np.int64) << 8)
    thick = np.flatnonzero(dense)
    for i in range(0, len(thick), 256):
        for r in thick[i:i + 256]:
            found = np.flatnonzero(np.unpackbits(data[offset[r]:offset[r + 1]], bitorder="little"))
            rows.append(np.full(len(found), r))
            docs.append(found)
    return np.concatenate(rows), np.concatenate(docs)


def _index(keep: list[str], names: list[str], path_a, path_b, with_groups: bool, limits: tuple[int, int]):
    def run(it):
        aligner, part, serial = aligner_of(path_a, path_b), TaskContext.get().partitionId(), 0
        kinds = {c: None for c in keep}

        def table(columns):
            n = len(columns["container"])
            made = [columns[c] if c in columns else pa.nulls(n, kinds.get(c) or TYPES[c]) for c in names]
            return pa.RecordBatch.from_arrays(made, names=names)

        def postings(parts, docs):
            keys, links = merge(parts)
            extra = links - 1
            for plane in range(int(extra.max()).bit_length() + 1 if len(extra) else 0):
                chosen = np.flatnonzero(extra >> (plane - 1) & 1) if plane else np.arange(len(keys))
                if len(chosen):
                    pair, population, dense, bits = posting(keys[chosen] >> DOC_BITS,
                                                            keys[chosen] & (1 << DOC_BITS) - 1, docs)
                    yield table({
                        "container": pa.array(np.full(len(pair), part << 33 | serial)),
                        "a": pa.array(pair >> aligner.bits_b, pa.int32()),
                        "b": pa.array(pair & (1 << aligner.bits_b) - 1, pa.int32()),
                        "plane": pa.array(np.full(len(pair), plane, np.int32)),
                        "population": pa.array(population, pa.int32()), "dense": pa.array(dense), "bits": bits})

        parts, docs, size = [], 0, 0
        for whole in batches(it, "__text", min(1 << 20, limits[1])):
            at = 0
            while at < whole.num_rows:
                batch = whole.slice(at, limits[0] - docs)
                texts = batch.column(batch.schema.get_field_index("__text")).to_pylist()
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in keep}
                kinds = {c: x.type for c, x in columns.items()}
                numbers, groups, keys, links = aligner.align(texts)
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()]
                columns |= {c: pa.array(numbers[:, i]) for i, c in enumerate(VALUES[:4])}
                columns |= {"groups_sha256": pa.array(digest, pa.string()), "groups": groups.cast(pa.string()),
                            "container": pa.array(np.full(len(texts), part << 33 | serial)),
                            "doc": pa.array(np.arange(docs, docs + len(texts)), pa.int32())}
                yield table(columns)
                parts.append((keys + docs, links))
                at, docs, size = at + len(texts), docs + len(texts), size + sum(len(t or "") for t in texts)
                if docs == limits[0] or size >= limits[1]:
                    yield from postings(parts, docs)
                    parts, docs, size, serial = [], 0, 0, serial + 1
        if docs:
            yield from postings(parts, docs)
    return run


#: Links that a document marked in a plane has by it.
WEIGHT = "shiftleft(1L, greatest(plane - 1, 0))"
VALUES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
TYPES = {"container": pa.int64(), "doc": pa.int32(), **{c: pa.int64() for c in VALUES[:4]}, "groups_sha256": pa.string(),
         "groups": pa.string(), "a": pa.int32(), "b": pa.int32(), "plane": pa.int32(), "population": pa.int32(),
         "dense": pa.bool_(), "bits": pa.binary()}


def _give_back(it):
    """Postings with their pair's count, sorted by container -> the sums of each document."""
    now, sums = None, np.zeros((2, 1 << 16), np.int64)

    def rows(container):
        found = np.flatnonzero(sums[1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), container, np.int64)), pa.array(found, pa.int32()),
                                           pa.array(sums[0][found]), pa.array(sums[1][found])],
                                          names=["container", "doc", "n_best", "count_sum"])

    for batch in it:
        container, weight, count, best = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        dense = batch.column(4).to_numpy(zero_copy_only=False)
        border = np.r_[0, np.flatnonzero(container[1:] != container[:-1]) + 1, len(container)]
        for i, j in zip(border[:-1], border[1:]):
            if i == j:
                continue
            if now is not None and now != container[i]:
                yield rows(now)
                sums[:] = 0
            now = container[i]
            row, doc = documents_of(dense[i:j], batch.column(5).slice(i, j - i))
            np.add.at(sums[0], doc, (weight[i:j] * best[i:j])[row])
            np.add.at(sums[1], doc, (weight[i:j] * count[i:j])[row])
    if now is not None:
        yield rows(now)


def inverted_index(spark: SparkSession, ws: Workspace, docs: DataFrame, text_col: str, keep: list[str],
                   path_a: str | None, path_b: str | None, with_groups: bool,
                   limits: tuple[int, int] = (DOCS, BYTES)) -> tuple[DataFrame, DataFrame]:
    """(documents, postings), both written: one row per document, one per pair, container and plane."""
    src = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("__text"))
    inner = [f"__k{i}" for i in range(len(keep))]
    values = VALUES + ["groups"] * with_groups
    schema = StructType(src.select(*inner).schema.fields)
    for c, kind in (("container", "long"), ("doc", "integer"), *[(c, "long") for c in VALUES[:4]], ("groups_sha256", "string"),
                    *[("groups", "string")] * with_groups, ("a", "integer"), ("b", "integer"), ("plane", "integer"),
                    ("population", "integer"), ("dense", "boolean"), ("bits", "binary")):
        schema = schema.add(c, kind)
    index = ws.save(src.mapInArrow(_index(inner, schema.names, path_a, path_b, with_groups, limits), schema), "index")
    return (index.filter("a IS NULL").select(*inner, "container", "doc", *values),
            index.filter("a IS NOT NULL").select("container", "a", "b", "plane", "population", "dense", "bits"))


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links): the populations of each pair's bitmaps."""
    return postings.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("population")).otherwise(0).cast("long")).alias("n_docs"),
        F.sum(F.col("population") * F.expr(WEIGHT)).alias("n_links"))


def align(spark: SparkSession, docs: DataFrame, text_col: str = "text", keep: list[str] = ("doc_id",),
          path_a: str | None = None, path_b: str | None = None, with_groups: bool = False,
          limits: tuple[int, int] = (DOCS, BYTES)) -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (, groups) of every row.

    ``path_a``: file of a byte-level BPE, ``path_b``: of a SentencePiece model; ``with_groups`` adds the groups as text;
    ``limits``: documents (65,536 at most) and bytes of a container.
    """
    ws, keep = Workspace(spark, "token_alignment"), list(keep)
    documents, postings = inverted_index(spark, ws, docs, text_col, keep, path_a, path_b, with_groups, limits)
    pairs = ws.save(pair_counts(postings), "pairs")
    # one row per id of tokenizer A at most: its vocabulary bounds the broadcast
    best = pairs.groupBy("a").agg(F.max("n_docs").alias("top"))
    counted = pairs.join(F.broadcast(best), "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))
    scored = (postings.join(counted, ["a", "b"])
              .select("container", F.expr(WEIGHT).alias("weight"), "n_docs",
                      F.col("best").cast("long").alias("best"), "dense", "bits"))
    sums = (scored.repartition("container").sortWithinPartitions("container")
            .mapInArrow(_give_back, "container long, doc int, n_best long, count_sum long"))
    zero = F.lit(0).cast("long")
    return documents.join(sums, ["container", "doc"], "left").select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], *VALUES[:4], F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *["groups"] * with_groups)
