"""Training-order materialisation of token ids.

Texts become sequences of a fixed number of token ids.  The sequences are numbered by document, a keyed Feistel permutation with cycle walking
gives every number a slot in 0 .. n-1, and slots are dealt out in ranges: each range is a shard of fixed-stride records in
slot order, so a reader seeks to any slot and resumes there.  The order depends on the rows and the seed, not on files or partitions.

Texts are tokenised once.  Their ids are written in two bytes each, compressed by document; counts for the numbering are read from that table, and ids
and finished records are shuffled, once each.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common, feistel
from tidewatch.session import cut_lineage

#: Records are handed on in batches of about this size.
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Layout:
    """A vocabulary file of ranks as public tokenizers have it, the split pattern, the id after each document's end, tokens per sequence,
    sequences per shard, and the seed of the order.  Ids take two bytes, little-endian."""

    ranks: str
    pattern: str
    end: int = 50256
    length: int = 512
    per_shard: int = 16384
    seed: str = "training order"

    @property
    def stride(self) -> int:
        return 2 * self.length

    def encoder(self):
        import base64

        import tiktoken
        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        if max(max(ranks.values()), self.end) > 0xFFFF:
            raise ValueError("two bytes do not hold this vocabulary's ids")
        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def public_layout(**changes) -> Layout:
    """The 50k byte-level vocabulary that the installed package of public tokenizers describes."""
    import public_tokenizers
    return Layout(ranks=str(public_tokenizers.path("byte_bpe_50k.tiktoken")), pattern=public_tokenizers.PATTERN, **changes)


def row_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(common.whole(text))))


def tokenised(rows: DataFrame, layout: Layout) -> DataFrame:
    """(k1, key, sequences, ids) of every row of (k1, key, text): the ids with the end id behind them, compressed; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pack = layout.encoder().encode_ordinary, zstandard.ZstdCompressor(level=3).compress
        end = struct.pack("<H", layout.end)
        for batch in batches:
            low = 0
            while low < len(batch):
                n, ids, size = [], [], 0
                while low < len(batch) and size < BATCH_BYTES:
                    found = np.array(encode(batch.column(2)[low].as_py()), dtype="<u2").tobytes() + end
                    n.append(-(-len(found) // layout.stride))
                    ids.append(pack(found))
                    size, low = size + len(ids[-1]), low + 1
                yield pa.RecordBatch.from_arrays([batch.column(0)[low - len(n):low], batch.column(1)[low - len(n):low], pa.array(n, pa.int64()),
                                                  pa.array(ids, pa.binary())], names=["k1", "key", "sequences", "ids"])
    return cut_lineage(rows.mapInArrow(run, "k1 bigint, key string, sequences bigint, ids binary"))


def materialised(docs: DataFrame, layout: Layout) -> DataFrame:
    """(shard, slot, doc_id, part, n_tokens, tokens) in slot order, a partition per shard.

    ``docs`` has doc_id and text; further columns are ignored.  ``tokens`` is one record of the layout's stride, the last of a document filled up with
    the end id; ``n_tokens`` counts the ids before that, the end id of the document included.  Null and empty texts give no sequence; repeated rows give
    their sequences as often; null ids come first in the numbering, and rows with equal ids are ordered by a hash of their text; an empty
    table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("k1"), row_key(F.col("doc_id"), F.col("text")).alias("key"),
                       common.whole(F.col("text")).alias("text")).filter("text <> ''")
    rows = tokenised(rows, layout)
    counts = rows.groupBy("k1", "key").agg(F.first("sequences").alias("each"), F.count("*").alias("copies"))
    counts = counts.withColumn("sequences", F.col("each") * F.col("copies"))
    starts, total = common.summed_before(common.ranged(counts, ["k1", "key"]), "sequences", "first")
    starts = cut_lineage(starts.select("key", "first", "copies", "each"))
    ids = rows.groupBy("key").agg(F.first("k1").alias("k1"), F.first("ids").alias("ids"))
    numbered = ids.join(starts, "key").select("k1", "ids", "first", "copies", "each")
    shards = max(1, -(-total // layout.per_shard))
    length, seed, per_shard, fill = layout.length, layout.seed, layout.per_shard, struct.pack("<H", layout.end)
    names = ["shard", "slot", "doc_id", "part", "n_tokens", "tokens"]

    def records(held: list[tuple[int | None, bytes, int, int]]) -> pa.RecordBatch:
        """One batch of the held documents: (doc_id, ids with the end, first number, sequences)."""
        each = np.array([h[3] for h in held])
        first_row = np.repeat(np.cumsum(each) - each, each)
        part = np.arange(len(first_row)) - first_row
        slots = feistel.permute(np.repeat([h[2] for h in held], each) + part, total, seed)
        sizes = np.minimum(np.repeat([len(h[1]) // 2 for h in held], each) - part * length, length)
        data = b"".join(h[1] + fill * (h[3] * length - len(h[1]) // 2) for h in held)
        places = np.arange(len(part) + 1, dtype=np.int32) * (2 * length)
        return pa.RecordBatch.from_arrays(
            [pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array([h[0] for h in held], pa.int64()).take(pa.array(np.repeat(np.arange(len(held)), each))),
             pa.array(part.astype(np.int32)), pa.array(sizes.astype(np.int32)),
             pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(places), pa.py_buffer(data)])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held, size = [], 0
        for batch in batches:
            doc_ids, firsts, all_copies, numbers = (batch.column(c).to_pylist() for c in (0, 2, 3, 4))
            for doc_id, packed, first, copies, each in zip(doc_ids, batch.column(1), firsts, all_copies, numbers):
                ids = unpack(packed.as_py())
                for copy in range(copies):
                    held.append((doc_id, ids, first + copy * each, each))
                    size += each * 2 * length
                    if size > BATCH_BYTES:
                        yield records(held)
                        held, size = [], 0
        if held:
            yield records(held)
    sequences = numbered.mapInArrow(run, "shard int, slot bigint, doc_id bigint, part int, n_tokens int, tokens binary")
    return sequences.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write_shards(records: DataFrame, uri: str, layout: Layout) -> DataFrame:
    """Writes the partitions of ``materialised`` as files of records; (shard, records) of each.

    A file appears under its name only when it is complete, so a task that runs again, on another executor or beside a slow twin, does no harm, and
    a shard that is there already in full is not written again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid
        store, path = pyarrow.fs.FileSystem.from_uri(uri)
        store.create_dir(path, recursive=True)
        out, shard, n, draft = None, None, 0, f"{path}/draft-{uuid.uuid4().hex}"
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0)[0].as_py() if shard is None else shard
            out = out or store.open_output_stream(draft)
            for record in batch.column(5):
                out.write(record.as_py())
            n += batch.num_rows
        if out is not None:
            out.close()
            store.move(draft, f"{path}/{shard_name(shard)}")
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64())], names=["shard", "records"])
    present = existing_shards(records.sparkSession, uri, layout)
    return records.filter(~F.col("shard").isin(present)).mapInArrow(run, "shard int, records bigint") if present else \
        records.mapInArrow(run, "shard int, records bigint")


def existing_shards(spark, uri: str, layout: Layout) -> list[int]:
    """Full shards that are written; the last shard, which may be shorter, counts as missing."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    files = store.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True))
    return sorted(int(f.base_name[6:-4]) for f in files
                  if f.base_name.startswith("shard-") and f.size == layout.per_shard * layout.stride)


def read_slots(uri: str, layout: Layout, first: int, count: int) -> np.ndarray:
    """``count`` records from slot ``first`` on, as rows of ids, fewer at the end of the last shard."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    parts, slot = [], first
    while slot < first + count:
        shard, place = divmod(slot, layout.per_shard)
        name = f"{path}/{shard_name(shard)}"
        if store.get_file_info(name).type != pyarrow.fs.FileType.File:
            break
        wanted = min(layout.per_shard - place, first + count - slot)
        with store.open_input_file(name) as file:
            data = file.read_at(wanted * layout.stride, place * layout.stride)
        parts.append(np.frombuffer(data, dtype="<u2").reshape(-1, layout.length))
        slot += wanted
        if len(data) < wanted * layout.stride:
            break
    return np.concatenate(parts) if parts else np.empty((0, layout.length), "<u2")


def query(spark, sf_dir: str) -> DataFrame:
    return materialised(common.table(spark, sf_dir, "documents"), public_layout())
