"""Token shards in training order.

Texts are tokenised once, packed into sequences of a fixed number of tokens (an end mark after
each text; a text may go on in the next sequence, and the last sequence of a task is filled up
with end marks) and staged. A sequence's number is its place among the staged ones; a keyed
Feistel network over the next even number of bits, walked until it falls below the number of
sequences, turns it into a global slot: a permutation that any reader can compute from the key.

Slots are dealt to tasks by range, sorted, and written as binary shards of a fixed stride: shard
``slot // per_shard``, byte ``(slot % per_shard) * stride``, little-endian tokens, no header. A
shard is written under another name and then renamed, so a task that runs again replaces it by
the same bytes. Reading from any slot on is one seek (``read_slots``). Hot sources or long texts
do not matter: slots are uniform. Long runs of white space are cut out before the pattern sees them,
since its look-ahead would run out of stack; the tokens are the same.

Defined cases: a null text is skipped; an empty one is a single end mark. Repeated rows are
separate texts. Rows without an id are kept, their segments have no id. An empty table gives no
shards and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, stage
from .frames import Batches, tidied
from .words import mixed

# Fixed value: how byte-level BPE vocabularies of this family cut a text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@dataclass(frozen=True)
class Layout:
    """Tokenizer file and pattern, shape of the shards, key of the order."""

    ranks: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = PATTERN
    end: int = 50256
    tokens: int = 2048       # of a sequence
    per_shard: int = 16384   # sequences of a shard
    key: int = 20240229
    rounds: int = 6

    @property
    def stride(self) -> int:
        return 2 * self.tokens


def feistel_slots(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slots of sequence numbers below ``n``: a permutation of 0 to n - 1."""
    half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [
        np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little"))
        for r in range(rounds)
    ]
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


STAGED_LEVEL = 9  # of zstd: staged sequences, shuffled ones and shards are on disk at once
LONG = 10_000  # white space: a longer run makes the pattern's look-ahead run out of stack
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)
PLAIN = r"\s+|\S+"


def cut_at_spaces(text: str) -> Iterator[tuple[bool, str]]:
    """(is white space, piece) where PATTERN cuts a text before and after long runs of white space:
    a run is one piece, but for its last character if a word follows, which goes on with that."""
    at = 0
    if len(text) >= LONG:
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            yield False, text[at:run.start()]
            yield True, text[run.start():end]
            at = end
    yield False, text[at:]


_encoders: dict[str, object] = {}


def _encoder(ranks: dict[bytes, int], pattern: str, name: str):
    if name not in _encoders:
        import tiktoken

        _encoders[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _encoders[name]


SEQUENCES = (
    "part int, number int, tokens binary, segments array<struct<doc_id:long,at:int,n:int>>"
)


class _Packer:
    """Texts one after another in sequences of a fixed length."""

    def __init__(self, layout: Layout, part: int):
        self.layout, self.part, self.number = layout, part, 0
        self.held, self.size, self.segments = [], 0, []
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        at = 0
        while at < len(tokens):
            some = tokens[at:at + self.layout.tokens - self.size]
            self.segments.append({"doc_id": doc_id, "at": self.size, "n": len(some)})
            self.held.append(some)
            self.size += len(some)
            at += len(some)
            if self.size == self.layout.tokens:
                self.close()

    def close(self) -> None:
        if not self.size:
            return
        rest = np.full(self.layout.tokens - self.size, self.layout.end, dtype="<u2")
        row = np.concatenate([*self.held, rest]).astype("<u2").tobytes()
        self.rows.append((self.part, self.number, row, self.segments))
        self.number += 1
        self.held, self.size, self.segments = [], 0, []

    def batch(self) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * 4
        self.rows = []
        kinds = [pa.int32(), pa.int32(), pa.binary(), kind]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["part", "number", "tokens", "segments"],
        )


def sequences(docs: DataFrame, layout: Layout, text="text", doc_id="doc_id") -> DataFrame:
    """Packed sequences with the task that made them and their number there."""
    context = docs.sparkSession.sparkContext
    ranks = context.broadcast(load_ranks(layout.ranks))  # one vocabulary file

    def pack(batches: Batches) -> Batches:
        name = f"{layout.ranks}:{layout.pattern}"
        encoder = _encoder(ranks.value, layout.pattern, name)
        spaces = _encoder(ranks.value, PLAIN, f"{layout.ranks}:{PLAIN}")
        packer = _Packer(layout, TaskContext.get().partitionId())
        end = np.array([layout.end], dtype="<u2")
        for batch in batches:
            for key, value in zip(*batch.columns, strict=True):
                if not value.is_valid:
                    continue
                ids = [
                    (spaces if blank else encoder).encode_to_numpy(piece, disallowed_special=()).astype("<u2")
                    for blank, piece in cut_at_spaces(value.as_py())
                ]
                packer.add(key.as_py(), np.concatenate([*ids, end]))
                if len(packer.rows) >= 256:
                    yield packer.batch()
        packer.close()
        yield packer.batch()

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(tidied(pack), SEQUENCES)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                    else os.path.abspath(folder))


class _Shard:
    """Consecutive sequences of one shard, under another name until it is whole."""

    def __init__(self, files: pafs.FileSystem, folder: str, number: int):
        self.files, self.name = files, f"{folder}/shard-{number:08d}.bin"
        self.number, self.partial = number, f"{folder}/.{uuid.uuid4().hex}.part"
        self.stream = files.open_output_stream(self.partial)

    def close(self) -> None:
        self.stream.close()
        self.files.move(self.partial, self.name)


MANIFEST = (
    "slot long, shard long, byte_offset long, n_tokens int, tokens_sha256 string, "
    "segments array<struct<doc_id:long,at:int,n:int>>"
)


def write_shards(docs: DataFrame, folder: str, layout: Layout = Layout(), text="text", doc_id="doc_id") -> DataFrame:
    """Write the shards of ``docs`` below ``folder`` and return one row per sequence.

    ``folder`` must be reachable by all executors, through any store that pyarrow.fs knows.
    """
    import zstandard

    spark = docs.sparkSession
    packed = os.path.join(shared_folder(spark), f"sequences-{uuid.uuid4().hex}")
    kept = sequences(docs, layout, text, doc_id).write.option("compression", "zstd")
    kept.option("parquet.compression.codec.zstd.level", STAGED_LEVEL).option("parquet.page.size", 8 << 20).parquet(packed)
    staged = spark.read.schema(SEQUENCES).parquet(packed)
    # Two numbers per task of the pass before.
    sizes = {r.part: r.n for r in staged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    offsets = np.zeros(max(sizes, default=0) + 1, dtype=np.int64)
    for part, size in sizes.items():
        offsets[part] = size
    offsets = spark.sparkContext.broadcast(np.cumsum(offsets) - offsets)
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/layout.json") as out:
        out.write(json.dumps({
            "sequences": n, "tokens": layout.tokens, "per_shard": layout.per_shard,
            "stride": layout.stride, "key": layout.key, "rounds": layout.rounds, "end": layout.end,
        }).encode())

    def place(batches: Batches) -> Batches:
        packer = zstandard.ZstdCompressor(3)
        for batch in batches:
            part, number, tokens, segments = batch.columns
            index = offsets.value[np.asarray(part)] + np.asarray(number)
            slot = feistel_slots(index, n, layout.key, layout.rounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array([packer.compress(t.as_buffer()) for t in tokens], pa.binary()),
                 segments],
                names=["slot", "tokens", "segments"],
            )

    def write(batches: Batches) -> Batches:
        unpacker, shard = zstandard.ZstdDecompressor(), None
        files, root = _filesystem(folder)
        for batch in batches:
            digests, sizes = [], []
            for slot, tokens, segments in zip(*batch.columns, strict=True):
                number = slot.as_py() // layout.per_shard
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.close()
                    shard = _Shard(files, root, number)
                raw = unpacker.decompress(tokens.as_buffer())
                shard.stream.write(raw)
                digests.append(hashlib.sha256(raw).hexdigest())
                sizes.append(sum(s["n"] for s in segments.as_py()))
            slots = np.asarray(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(slots // layout.per_shard),
                 pa.array(slots % layout.per_shard * layout.stride),
                 pa.array(sizes, pa.int32()), pa.array(digests, pa.string()), batch.column(2)],
                names=[c.split()[0] for c in MANIFEST.split(", ")],
            )
        if shard is not None:
            shard.close()

    shards = max(1, -(-n // layout.per_shard))
    placed = staged.mapInArrow(
        place, "slot long, tokens binary, segments array<struct<doc_id:long,at:int,n:int>>"
    )
    dealt = placed.repartitionById(shards, F.floor(F.col("slot") / layout.per_shard).cast("int"))
    # Written once, here: the manifest is a table, and reading it writes no shard again.
    return stage(dealt.sortWithinPartitions("slot").mapInArrow(write, MANIFEST), "manifest")


def read_slots(folder: str, first: int, n: int) -> np.ndarray:
    """The sequences of ``n`` slots from ``first`` on, as rows of tokens, by seeking."""
    files, root = _filesystem(folder)
    with files.open_input_stream(f"{root}/layout.json") as stream:
        layout = json.loads(stream.read())
    out = []
    last = min(first + n, layout["sequences"])
    while first < last:
        shard, at = divmod(first, layout["per_shard"])
        count = min(last - first, layout["per_shard"] - at)
        with files.open_input_file(f"{root}/shard-{shard:08d}.bin") as stream:
            stream.seek(at * layout["stride"])
            out.append(np.frombuffer(stream.read(count * layout["stride"]), dtype="<u2"))
        first += count
    whole = np.concatenate(out) if out else np.zeros(0, dtype="<u2")
    return whole.reshape(-1, layout["tokens"])


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for one set of shards, in the shared one."""
    return os.path.join(shared_folder(spark), f"shards-{uuid.uuid4().hex}")
