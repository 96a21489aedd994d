"""Alignment of the tokens of two vocabularies by products of incidence matrices (operator 12).

A text's tokens under each vocabulary cover the same bytes. With a row for each token and a column for each byte, both
coverings are matrices in compressed sparse rows, built by hand; the rows of A·Bᵀ, formed as Gustavson does (for each entry of a row of
A, the row of Bᵀ that it names; equal columns merged), hold the tokens of B that a token of A overlaps and by how many bytes. Byte offsets where
both have an end cut the tokens into groups; the product of the two matrices of tokens by groups holds all pairs of a
group, of which only the sizes of the rows are formed unless the pairs are asked for. Products are formed for CHUNK_BYTES of text at a time, cut between groups.

Neither vocabulary joins what stands before a space to the space and the visible character behind it, so a text falls into
segments whose tokens and groups do not depend on the rest; a task remembers up to KNOWN_SEGMENTS of them.

Corpus-wide counts of id pairs need no row per link in a shuffle. A task gathers texts into blocks of about BLOCK_LINKS links; a
block keeps its distinct id pairs, their counts, and its links as places in that list. The blocks are written once, the
lists are added up, and each block gets the totals of its own pairs back.

Texts that are null, empty or not given back by the tokens' bytes have no tokens: zeros and an empty digest. Special strings
are plain text. A very long text is a block of its own. Repeated rows are counted each; ties for the highest count all count; an empty table gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import map_texts, pieces, texts_of
from chartlift.llm.merges import byte_characters, vocabulary_path
from chartlift.runtime import scratch_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# The pattern that cuts texts before A's merges, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_BYTES = 1_000_000
BLOCK_LINKS = 4_000_000
KNOWN_SEGMENTS = 300_000
TOGETHER = 2000  # segments encoded at once
_IDS_B = 1 << 24  # an id pair is a * _IDS_B + b
_LONG_BLANK = re.compile(r"\s{4000}")
_CUT = re.compile(r"(?<! ) (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")


@dataclass
class Rows:
    """A matrix in compressed sparse rows: row i has the columns columns[starts[i]:starts[i + 1]]."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(starts, self.owners()[order], len(self.starts) - 1)

    def product_sizes(self, other: Rows) -> np.ndarray:
        """How many entries each row of the product has before equal columns are merged."""
        sizes = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])
        return np.diff(sizes[self.starts])

    def product(self, other: Rows) -> tuple[Rows, np.ndarray]:
        """Gustavson's product of matrices of ones, and the value of each of its entries."""
        sizes = np.diff(other.starts)[self.columns]
        ends = np.cumsum(sizes)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        column = other.columns[np.repeat(other.starts[self.columns], sizes) + inside]
        key = np.repeat(self.owners(), sizes) * other.width + column
        if np.any(key[1:] < key[:-1]):
            key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        value = np.diff(np.append(first, len(key)))
        row, column = np.divmod(key[first], max(1, other.width))
        starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.starts) - 1))])
        return Rows(starts, column, other.width), value


def _cover(ends: np.ndarray) -> Rows:
    """Tokens by bytes."""
    starts = np.concatenate([[0], ends])
    return Rows(starts, np.arange(starts[-1]), int(starts[-1]))


def _grouped(groups: np.ndarray, count: int) -> Rows:
    """Tokens by groups."""
    return Rows(np.arange(len(groups) + 1), groups, count)


class Vocabularies:
    """Ids and bytes of the tokens of texts under both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_file(path_a)
        self.slow.encode_special_tokens = True
        number = {c: b for b, c in enumerate(byte_characters())}
        added = self.slow.get_added_tokens_decoder()
        table = {i: bytes(number[c] for c in name) for name, i in self.slow.get_vocab().items() if i not in added}
        # Ids are the order of the merges, so this library gives the same tokens in a third of the time.
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={b: i for i, b in table.items()}, special_tokens={})
        self.piece = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [table.get(i, b"") for i in range(self.slow.get_vocab_size())]
        if any("▁" in self.piece.id_to_piece(i).lstrip("▁") for i in range(self.piece.get_piece_size())):
            raise ValueError("a piece of B spans the beginning of a word")
        self.bytes_b = [self._piece_bytes(i) for i in range(self.piece.get_piece_size())]
        self.length_a = np.array([len(b) for b in self.bytes_a])
        self.length_b = np.array([len(b) for b in self.bytes_b])

    def _piece_bytes(self, i: int) -> bytes:
        name = self.piece.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.piece.is_byte(i) else name.replace("▁", " ").encode()

    def _ids_a(self, text: str) -> list[int]:
        # The fast library's pattern needs stack for long runs of blanks.
        if len(text) > 4000 and _LONG_BLANK.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text; none if the tokens' bytes are not the text's."""
        for text in texts:
            a, b = (self._ids_a(" " + text), self.piece.encode(text)) if text else ([], [])
            if text:
                raw = b" " + text.encode()
                if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                    a, b = [], []
            yield np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, chunk: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token of A, token of B, bytes in common) of all tokens that overlap, for parts of a text cut between groups."""
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    at = from_a = from_b = 0
    while at < (cuts[-1] if len(cuts) else 0):
        stop = cuts[max(np.searchsorted(cuts, at + chunk, side="right") - 1, np.searchsorted(cuts, at, side="right"))]
        to_a, to_b = np.searchsorted(ends_a, stop, side="right"), np.searchsorted(ends_b, stop, side="right")
        found, shared = _cover(ends_a[from_a:to_a] - at).product(_cover(ends_b[from_b:to_b] - at).transposed())
        yield found.owners() + from_a, found.columns + from_b, shared
        at, from_a, from_b = stop, to_a, to_b


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A and of B, and the number of groups."""
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts)


def segments_of(text: str) -> list[str]:
    """The parts of a text that both vocabularies encode apart, without the one space in front of each."""
    spaced = " " + text
    if not _ODD.search(spaced):
        return text.split(" ")
    first, *rest = _CUT.split(spaced)
    return [first[1:], *rest] if first else rest


class Segments:
    """What is known of segments: their numbers of tokens and groups, their links, and their groups in the form ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, both: Vocabularies):
        self.both = both
        size_a, size_b = len(both.bytes_a), len(both.bytes_b)
        self.names = [f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;\n")) for mark in marks for i in range(size)]
        self.size_a, self.size_b = size_a, size_b
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.sizes = np.zeros((5, 0), dtype=np.int64)  # tokens of A, of B, groups, links, links within groups
        self.valid = np.zeros(0, dtype=bool)
        self.links = np.zeros(0, dtype=np.int64)
        self.ends = np.zeros(0, dtype=np.int64)  # of each segment's links

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.number) > KNOWN_SEGMENTS:
            self.forget()
        new = list(dict.fromkeys(s for text in texts for s in text if s not in self.number))
        if not new:
            return
        both = self.both
        # Segments without blanks at their ends are encoded many at once, as in a text; the others one at a time.
        whole = [s for s in new if not s[0].isspace() and s[-1] != " "]
        single = [s for s in new if s[0].isspace() or s[-1] == " "]
        new, parts = whole + single, []
        for start in range(0, len(whole), TOGETHER):
            parts += self._together(whole[start : start + TOGETHER])
        parts += map(self._alone, single)
        valid = np.concatenate([v for v, *_ in parts])
        sizes = np.zeros((5, len(new)), dtype=np.int64)
        sizes[0], sizes[1] = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        a, b = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (3, 4))
        segment_a, segment_b = np.repeat(np.arange(len(new)), sizes[0]), np.repeat(np.arange(len(new)), sizes[1])
        ends_a, ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
        groups_a, groups_b, count = groups_of(ends_a, ends_b)
        found = [(segment_a[i], a[i] * _IDS_B + b[j]) for i, j, _ in overlaps(ends_a, ends_b)]
        owner = np.concatenate([np.zeros(0, dtype=np.int64), *(s for s, _ in found)])
        by_group = _grouped(groups_a, count).product_sizes(_grouped(groups_b, count).transposed())
        last_a, last_b = np.append(groups_a[1:] != groups_a[:-1], True), np.append(groups_b[1:] != groups_b[:-1], True)
        sizes[2] = np.bincount(segment_a, weights=last_a[: len(a)], minlength=len(new))
        sizes[3] = np.bincount(owner, minlength=len(new))
        sizes[4] = np.bincount(segment_a, weights=by_group, minlength=len(new))
        written = iter(self._written(a, b, groups_a, groups_b, last_a, last_b, np.append(segment_b[1:] != segment_b[:-1], True), count))
        self.texts += [next(written) if ok else "" for ok in valid]
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.ends = np.concatenate([self.ends, len(self.links) + np.cumsum(sizes[3])])
        self.links = np.concatenate([self.links, *(pairs for _, pairs in found)])
        self.sizes, self.valid = np.concatenate([self.sizes, sizes], axis=1), np.concatenate([self.valid, valid])

    def _together(self, some: list[str]) -> list[tuple]:
        """(valid, numbers of tokens of A and of B, all ids of A, all ids of B) of segments encoded as one text."""
        both, raw = self.both, " " + " ".join(some)
        a, b = both._ids_a(raw), both.piece.encode(raw[1:])
        if not b"".join(map(both.bytes_a.__getitem__, a)) == raw.encode() == b"".join(map(both.bytes_b.__getitem__, b)):
            return list(map(self._alone, some))
        a, b = np.array(a), np.array(b)
        ends = np.cumsum([len(s.encode()) + 1 for s in some])
        counts = (np.diff(np.searchsorted(np.cumsum(length[ids]), ends, side="right"), prepend=0) for length, ids in ((both.length_a, a), (both.length_b, b)))
        return [(np.ones(len(some), dtype=bool), *counts, a, b)]

    def _alone(self, segment: str) -> tuple:
        both, raw = self.both, b" " + segment.encode()
        a, b = both._ids_a(" " + segment), both.piece.encode(segment)
        valid = b"".join(map(both.bytes_a.__getitem__, a)) == raw == b"".join(map(both.bytes_b.__getitem__, b))
        if not valid:
            a, b = [], []
        return np.array([valid]), np.array([len(a)]), np.array([len(b)]), np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def _written(self, a, b, groups_a, groups_b, last_a, last_b, end_b, count) -> list[str]:
        """The groups of each segment that has tokens: names of tokens of A and B in turn, each with the mark behind it."""
        before_a = np.concatenate([[0], np.cumsum(np.bincount(groups_b, minlength=count))])[groups_a]
        before_b = np.cumsum(np.bincount(groups_a, minlength=count))[groups_b]
        names = np.empty(len(a) + len(b), dtype=np.int64)
        names[np.arange(len(a)) + before_a] = a + self.size_a * last_a[: len(a)]
        names[np.arange(len(b)) + before_b] = 2 * self.size_a + b + self.size_b * (last_b[: len(b)].astype(np.int64) + end_b[: len(b)])
        return "".join(map(self.names.__getitem__, names.tolist())).split("\n")

    def __call__(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
        """The sizes and links of a text of known segments, and the digest of its groups; zeros and nothing if one is not valid."""
        place = np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))
        if not len(place) or not self.valid[place].all():
            return np.zeros(5, dtype=np.int64), np.zeros(0, dtype=np.int64), ""
        counts = self.sizes[3][place]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        links = self.links[np.repeat(self.ends[place] - counts, counts) + within]
        digest = hashlib.sha256(";".join(map(self.texts.__getitem__, place.tolist())).encode()).hexdigest()
        return self.sizes[:, place].sum(axis=1), links, digest


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string"
_DOCS = f"array<struct<{', '.join(part.replace(' ', ':') for part in _DOC.split(', ')).replace(', ', ',')}>>"
_BLOCK = f"block long, pairs array<long>, counts array<long>, docs {_DOCS}, links binary"


def _blocks(path_a: str, path_b: str, block_links: int):
    def run(batches):
        known = Segments(Vocabularies(path_a, path_b))
        number = TaskContext.get().partitionId() << 32
        docs, pairs, held = [], [], 0

        def block():
            links = np.concatenate([np.zeros(0, dtype=np.int64), *pairs])
            distinct, place, counts = np.unique(links, return_inverse=True, return_counts=True)
            packed = zstandard.ZstdCompressor(level=1).compress(place.astype("<u4").tobytes())
            kind = pa.list_(pa.struct([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in _DOC.split(", "))]))
            columns = [pa.array([number], pa.int64()), pa.array([distinct], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([docs], kind), pa.array([packed], pa.binary())], names=["block", "pairs", "counts", "docs", "links"])

        for batch in pieces(batches):
            texts = [segments_of(text) if text else [] for text in batch.column("text").to_pylist()]
            known.learn(texts)
            for name, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                sizes, links, digest = known(text)
                doc = dict(zip(("n_a", "n_b", "n_groups", "n_links", "n_group_links"), sizes.tolist(), strict=True))
                doc |= {"doc_id": name, "groups_sha256": digest}
                pairs.append(links)
                held += len(links)
                docs.append(doc)
                if held >= block_links or len(docs) >= block_links // 50:
                    yield block()
                    docs, pairs, held, number = [], [], 0, number + 1
        if docs:
            yield block()

    return run


def _judge(blocks: pa.Table, totals: pa.Table) -> pa.Table:
    """The documents of one block with the totals of its pairs."""
    docs = blocks.column("docs").combine_chunks().flatten()
    docs = {name: docs.field(i) for i, name in enumerate(f.name for f in docs.type)}
    packed = blocks.column("links")[0].as_py()
    links = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype="<u4")
    place = totals.column("place").to_numpy()
    total, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    total[place] = totals.column("total").to_numpy()
    best[place] = totals.column("best").to_numpy()
    ends = np.cumsum(docs["n_links"].to_numpy())
    for name, values in (("n_best", best), ("count_sum", total)):
        sums = np.concatenate([[0], np.cumsum(values[links])])
        docs[name] = pa.array(sums[ends] - sums[np.concatenate([[0], ends[:-1]])], pa.int64())
    return pa.table({name: docs[name] for name in _OUT})


_OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]


def alignment(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, block_links: int = BLOCK_LINKS
) -> DataFrame:
    """For each text the numbers of its tokens, groups and links, and what the corpus says about its links."""
    spark = docs.sparkSession
    paths = vocabulary_path(VOCABULARY_A, folder), vocabulary_path(VOCABULARY_B, folder)
    where = scratch_path(spark, "alignment-blocks")
    texts_of(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col).mapInArrow(_blocks(*paths, block_links), _BLOCK).write.parquet(where)
    blocks = spark.read.schema(_BLOCK).parquet(where)
    counted = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("row")).groupBy(F.col("row.pairs").alias("pair")).agg(F.sum("row.counts").alias("total"))
    token_b = F.col("pair") % _IDS_B
    highest = counted.groupBy(token_b.alias("b")).agg(F.max("total").alias("highest"))
    # At most one row for each id of B: a proven bound for the broadcast.
    scored = counted.withColumn("b", token_b).join(F.broadcast(highest), "b")
    scored = scored.select("pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    totals = asked.join(scored, "pair").select(F.col("block").alias("asking"), F.col("place").cast("long").alias("place"), "total", "best")
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in _OUT)
    return blocks.select("block", "docs", "links").groupBy("block").cogroup(totals.groupBy("asking")).applyInArrow(_judge, schema)


def token_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """A row for each link: doc_id, the places and ids of both tokens, the bytes they share and their group."""
    paths = vocabulary_path(VOCABULARY_A, folder), vocabulary_path(VOCABULARY_B, folder)

    def make():
        both = Vocabularies(*paths)

        def handle(ids, texts):
            out = {"doc_id": [], "links": []}
            for name, (a, b) in zip(ids, both.encode(texts), strict=True):
                ends_a, ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
                group = groups_of(ends_a, ends_b)[0]
                rows = [
                    {"place_a": x, "place_b": y, "id_a": int(a[x]), "id_b": int(b[y]), "n_bytes": z, "link_group": int(group[x])}
                    for i, j, n in overlaps(ends_a, ends_b) for x, y, z in zip(i.tolist(), j.tolist(), n.tolist(), strict=True)
                ]
                out["doc_id"].append(name)
                out["links"].append(rows)
            return out

        return handle

    kind = "array<struct<place_a:long,place_b:long,id_a:long,id_b:long,n_bytes:long,link_group:long>>"
    found = map_texts(texts_of(docs, id_col, text_col), make, f"doc_id long, links {kind}")
    return found.select("doc_id", F.inline("links"))
