"""Token ids packed into rows of one length, as binary matrices.

Texts become ids of 16 bits, those longer than a row are cut into pieces without losing an
id. Pieces are dealt to shards by a hash; within a shard they are packed best fit
decreasing: the longest piece first, into the row whose free space is the least that holds
it. A segment tree over free space finds that row. Every packed row keeps its ids, the
cumulative lengths of its segments, its positions (from 0 again in each segment) and which
piece of which document each segment is.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import bpe, common

ROW_TOKENS = 2048
#: Bytes of text that a shard is planned for, and ids after which a shard is packed anyway.
SHARD_BYTES = 4_000_000
SHARD_TOKENS = 16_000_000
PACKED = (
    "shard int, part int, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
    "position_ids binary, doc_ids array<bigint>, pieces array<int>"
)


@lru_cache(maxsize=2)
def encoder(ranks: bytes) -> tiktoken.Encoding:
    """A rank file's encoder, once in each worker process."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    mergeable = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        "ranks", pat_str=bpe.SPLIT, mergeable_ranks=mergeable, special_tokens={}
    )


class Capacities:
    """A segment tree over free space 0..``most``: how many open rows have just that much."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        node = self.size + space
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(space, row)`` of least space from ``need`` on."""
        node, count = self.size + need, self.count
        while not count[node]:
            # up to where a subtree of larger spaces begins, then down its least
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        space = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return space, self.rows[space].pop()


def best_fit(lengths: list[int], row_tokens: int) -> list[list[int]]:
    """Indices of pieces by row; ``lengths`` descend and none exceeds ``row_tokens``."""
    spaces, rows = Capacities(row_tokens), []
    for i, length in enumerate(lengths):
        found = spaces.take(length)
        if found is None:
            space, row = row_tokens, len(rows)
            rows.append([])
        else:
            space, row = found
        rows[row].append(i)
        if space > length:
            spaces.add(space - length, row)
    return rows


def pieces(
    df: DataFrame, ranks: bytes, row_tokens: int, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """``(id, piece, n, ids)`` for each piece of each text; an empty or null text has none."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    common.prepare(df.sparkSession)

    def run(batches):
        tool = encoder(shared.value)
        for batch in common.slices(batches, 256):
            ids, numbers, lengths, packed = [], [], [], []
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                coded = array("H", tool.encode_ordinary(value)).tobytes()
                for start in range(0, len(coded), 2 * row_tokens):
                    piece = coded[start : start + 2 * row_tokens]
                    ids.append(own)
                    numbers.append(start // (2 * row_tokens))
                    lengths.append(len(piece) // 2)
                    packed.append(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    common.longs(ids),
                    pa.array(numbers, pa.int32()),
                    pa.array(lengths, pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                ["id", "piece", "n", "ids"],
            )

    source = df.select(F.col(f"`{id}`").cast("long").alias("id"), common.whole(text).alias("t"))
    return source.mapInArrow(run, "id long, piece int, n int, ids binary")


def _packed(shard: int, part: int, rows: list[tuple], row_tokens: int, pad: int):
    """Packed rows of one part of a shard; ``rows`` are ``(id, piece, n, ids)``."""
    rows.sort(key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1], r[3]))
    for number, members in enumerate(best_fit([r[2] for r in rows], row_tokens)):
        own = [rows[i] for i in members]
        lengths = [r[2] for r in own]
        total = sum(lengths)
        positions = np.concatenate([*(np.arange(n) for n in lengths), np.zeros(row_tokens - total, int)])
        yield (
            shard,
            part,
            number,
            total,
            b"".join(r[3] for r in own) + np.full(row_tokens - total, pad, "<u2").tobytes(),
            [0, *np.cumsum(lengths).tolist()],
            positions.astype("<u2").tobytes(),
            [r[0] for r in own],
            [r[1] for r in own],
        )


def pack(
    df: DataFrame,
    ranks: bytes,
    *,
    row_tokens: int = ROW_TOKENS,
    pad: int = 50_256,
    text: str = "text",
    id: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """The whole texts of ``df`` as packed rows, see ``PACKED``; ids are little-endian.

    Joining the ids of a document's segments in order of ``pieces`` gives its ids. Rows hold
    ``row_tokens`` ids, the rest is ``pad``. Every row of ``df`` is packed, repeated ones each
    (their segments can't be told apart by id); empty and null texts take no space, a null id
    stays null. Other columns are left out. A task holds one part of a shard, never more than
    ``shard_tokens`` ids: a shard beyond that, as many copies of one id make it, has several
    parts.
    """
    if not 0 < row_tokens <= 65_535:
        raise ValueError("row_tokens must fit 16 bits")
    size = df.agg(F.sum(F.octet_length(common.whole(text)))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    dealt = pieces(df, ranks, row_tokens, text, id).select(
        F.pmod(F.xxhash64("id", "piece", "n"), F.lit(shards)).cast("int").alias("shard"), "*"
    )
    kinds = [pa.int32()] * 4 + [pa.binary(), pa.list_(pa.int32()), pa.binary(),
                                pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [x.split()[0] for x in PACKED.split(", ")]

    def batches_of(rows):
        held = []
        for row in rows:
            held.append(row)
            if len(held) == 512:
                yield held
                held = []
        if held:
            yield held

    def run(batches):
        def flush(shard, part, rows):
            for held in batches_of(_packed(shard, part, rows, row_tokens, pad)):
                columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

        shard, part, held, tokens = None, 0, [], 0
        for batch in batches:
            for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own != shard or tokens >= shard_tokens:
                    if held:
                        yield from flush(shard, part, held)
                    part = part + 1 if own == shard else 0
                    shard, held, tokens = own, [], 0
                held.append(tuple(row))
                tokens += row[2]
        if held:
            yield from flush(shard, part, held)

    # as many partitions as the session has; a partition's shards follow one another
    return dealt.repartition("shard").sortWithinPartitions("shard", "id", "piece").mapInArrow(run, PACKED)


def read_ranks(path: str) -> bytes:
    """A rank file (under 1 MB) as bytes; tasks get it by broadcast."""
    with open(path, "rb") as file:
        return file.read()


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2048 ids."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pack(common.table(spark, sf_dir, "documents").select("doc_id", "text"), ranks)
