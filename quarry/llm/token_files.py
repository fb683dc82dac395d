"""Operator 4: token ids to binary files that readers can enter at any document.

Documents are range-partitioned and sorted by id; every task encodes its range and writes one shard
(:mod:`quarry.llm.frames`). The manifest, an ordinary table, has a row per frame: shard
number, file, frame, the ids and lengths of its documents and where it starts in its shard. A task that runs again
writes a file of another name and only the manifest of the attempt that Spark kept names a file, so lost executors and
speculative copies leave whole results.

White space never reaches a token of the tokenizer, so a text's ids are those of its pieces between
blanks; a worker encodes each piece it has not met with the tokenizers library and remembers a bounded number.

Edge cases: a null or empty text is the end id alone; a null id comes first; repeated rows each have their place;
rows of one id are spread by their text's hash; other columns are left out; an empty table gives no file and no row.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import frames
from .common import by_volume, claim, query, shared_path, stored, table

WORD_BPE = "word_bpe_49k.json"
END_ID = 1
FRAME_BYTES = 1 << 18          # a frame is closed when it holds this much; a longer document is a frame of its own
TEXT_PER_BATCH = 2 << 20
CACHED_PIECES = 800_000
PIECES_PER_TEXT, WORDS_PER_TEXT = 500, 20_000
MANIFEST = ("shard int, file string, frame int, doc_ids array<bigint>, counts array<bigint>, start_in_shard bigint")

_odd_blank = re.compile("[\x1c-\x1f]")     # white space to Python, not to Unicode or the tokenizer
_blank = re.compile(r"[ \n\r\t]+")
_tail = re.compile("(?<=[a-zß-öø-ÿ])[,.]+(?=\\n|\\Z)")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _piece_ids(pieces: list[str], path: str) -> list[bytes]:
    """The ids of each piece. Pieces are encoded many at a time with a special token between them, which the tokenizer
    takes out of a text before anything else; pieces that hold it are encoded on their own."""
    tokenizer, mark, mark_id = _tokenizer(path), *_separator(path)
    alone = [p for p in pieces if mark is None or mark in p]
    known = dict(zip(alone, (np.array(e.ids, dtype="<u4").tobytes() for e in tokenizer.encode_batch_fast(alone, add_special_tokens=False)),
                     strict=True))
    rest = [p for p in pieces if p not in known]
    for i in range(0, len(rest), PIECES_PER_TEXT):
        part = rest[i:i + PIECES_PER_TEXT]
        (joined,) = tokenizer.encode_batch_fast([mark.join(part)], add_special_tokens=False)
        ids = np.array(joined.ids, dtype="<u4")
        ends = np.append(np.nonzero(ids == mark_id)[0], len(ids))
        if len(ends) != len(part):
            raise ValueError("a piece holds a special token")
        raw, start = ids.tobytes(), 0
        for p, end in zip(part, ends.tolist(), strict=True):
            known[p] = raw[4 * start:4 * end]
            start = end + 1
    return [known[p] for p in pieces]


@functools.lru_cache(maxsize=2)
def _separator(path: str) -> tuple[str | None, int]:
    """A special token that is taken out of texts as it stands, and its id."""
    for token_id, token in _tokenizer(path).get_added_tokens_decoder().items():
        if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word):
            return token.content, token_id
    return None, -1


@functools.lru_cache(maxsize=2)
def _letters(path: str):
    """The tokenizer cut down to words of small Latin-1 letters, and which ids end a word; (None, None) where that would not be
    exact.

    On such words the normalisers that are allowed here change nothing, the word is one match of the pattern, and its last token, and
    no other, has the end-of-word suffix.
    """
    with open(path, "rb") as f:
        spec = json.load(f)
    model, norms = spec["model"], (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]])
    splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    harmless = all(n is None or n["type"] in ("NFC", "Lowercase") or
                   n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in norms)
    words = [x["type"] for x in splits] == ["Split", "ByteLevel"] and r"|[\p{L}]+|" in splits[0]["pattern"].get("Regex", "") \
        and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and not splits[1]["use_regex"]
    if not (harmless and words and model["type"] == "BPE" and model["end_of_word_suffix"]):
        return None, None
    from tokenizers import Tokenizer, normalizers, pre_tokenizers
    tokenizer = Tokenizer.from_file(path)
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
    ends[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
    return tokenizer, ends


def _learn(new: list[str], path: str, known) -> list[bytes]:
    """The ids of each piece. A piece of small Latin-1 letters, with or without commas and full stops behind (tokens of their own), goes the
    fast way: its letters, if not among the ``known`` pieces, with those of the other pieces as one text. All others are encoded as they stand."""
    tokenizer, ends = _letters(path)
    cores = _tail.sub("", "\n".join(new)).split("\n") if tokenizer else [""] * len(new)
    wanted, ids_of = {c for c in cores if c.isalpha() and c.islower() and _small(c)}, {}
    words = []
    for c in wanted:
        ids_of[c] = known.found(c)
        if ids_of[c] is None:
            words.append(c)
    for i in range(0, len(words), WORDS_PER_TEXT):
        part = words[i:i + WORDS_PER_TEXT]
        (joined,) = tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
        ids = np.array(joined.ids, dtype="<u4")
        stops = (np.nonzero(ends[ids])[0] + 1).tolist()
        if len(stops) != len(part) or stops[-1] != len(ids):
            raise ValueError("the tokens of a text do not end with its words")
        raw = ids.tobytes()
        ids_of.update(zip(part, [raw[4 * a:4 * b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))
    tails = {p[len(c):] for p, c in zip(new, cores, strict=True) if len(c) < len(p) and c in wanted}
    rest = list(tails.union(p for p, c in zip(new, cores, strict=True) if c not in wanted))
    others = dict(zip(rest, _piece_ids(rest, path), strict=True))
    return [others[p] if c not in wanted else ids_of[c] if len(c) == len(p) else ids_of[c] + others[p[len(c):]]
            for p, c in zip(new, cores, strict=True)]


def _small(word: str) -> bool:
    return word.isascii() or max(word) <= "\xff"


def _lowered(text: str, path: str) -> str:
    """The text in lower case where that leaves its ids as they are: in Latin-1, without anything like a special token."""
    if _letters(path)[0] is None or "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class _Pieces(dict):
    """Pieces by number, and the ids of all of them one after the other; ``new`` are those whose ids are still to be found."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.new, self.ids, self.ends = [], array("I"), array("q", [0])

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self) + 1
        self.new.append(piece)
        return number

    def found(self, piece: str) -> bytes | None:
        """The ids of a piece, if they are known."""
        number = self.get(piece, len(self.ends))
        return self.ids[self.ends[number - 1]:self.ends[number]].tobytes() if number < len(self.ends) else None

    def learn(self, path: str) -> None:
        if self.new:
            found = _learn(self.new, path, self)
            self.ids.frombytes(b"".join(found))
            self.ends.extend((self.ends[-1] + np.cumsum([len(f) // 4 for f in found])).tolist())
            self.new = []


_pieces: dict[str, _Pieces] = {}


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each whole text as little-endian unsigned 32-bit integers, without special tokens added."""
    known = _pieces.setdefault(path, _Pieces())
    low = [_lowered(t, path) if t else "" for t in texts]
    split = [_blank.split(t) if _odd_blank.search(t) else t.split() for t in low]
    if len(known) > CACHED_PIECES:
        known.clear()
    at = np.fromiter(itertools.chain.from_iterable(map(known.__getitem__, ps) for ps in split), dtype=np.int64, count=sum(map(len, split)))
    known.learn(path)
    ends = np.frombuffer(known.ends, dtype=np.int64)
    start, size = ends[at - 1], ends[at] - ends[at - 1]
    upto = np.cumsum(size)
    ids = np.frombuffer(known.ids, dtype=np.uint32)[np.arange(upto[-1] if len(at) else 0) + np.repeat(start - upto + size, size)].astype("<u4")
    bounds = np.concatenate([[0], upto])[np.cumsum([0, *map(len, split)])].tolist()
    return [ids[a:b].tobytes() for a, b in itertools.pairwise(bounds)]


def _write_batches(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    claim(_pieces.setdefault(path, _Pieces()))
    shard, end = TaskContext.get().partitionId(), np.array([end_id], dtype="<u4").tobytes()
    writer, name, start = None, f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids.zst", 0
    held, ids, size = [], [], 0

    def flush():
        nonlocal held, ids, size, start, writer
        if writer is None:
            writer = frames.ShardWriter(name)
        counts = [len(b) // 4 for b in held]
        frame = writer.write(b"".join(held))
        row = pa.RecordBatch.from_pylist(
            [{"shard": shard, "file": name, "frame": frame, "doc_ids": ids, "counts": counts, "start_in_shard": start}],
            schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("frame", pa.int32()),
                              ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                              ("start_in_shard", pa.int64())]))
        start += sum(counts)
        held, ids, size = [], [], 0
        return row

    for batch in by_volume(batches, "text", TEXT_PER_BATCH):
        for doc_id, content in zip(batch.column(0).to_pylist(), encode_texts(batch.column(1).to_pylist(), path), strict=True):
            held.append(content + end)
            ids.append(doc_id)
            size += len(held[-1])
            if size >= FRAME_BYTES:
                yield flush()
    if held:
        yield flush()
    if writer is not None:
        writer.close()


def write_shards(df: DataFrame, folder: str, path: str, id_col: str = "doc_id", text: str = "text",
                 end_id: int = END_ID) -> DataFrame:
    """Writes the ids of every text, ``end_id`` after each, as shards in ``folder``, in ascending id order; the manifest.

    ``folder`` must be open to all executors; ``path`` is the tokenizer's file.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).withColumn("spread", F.xxhash64("text"))
    ranged = docs.repartitionByRange("id", "spread").sortWithinPartitions("id", "spread").drop("spread")
    return stored(ranged.mapInArrow(lambda it: _write_batches(it, folder, path, end_id), MANIFEST), "manifest")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = None
    for batch in batches:
        for row in batch.to_pylist():
            if reader is None or reader.path != row["file"]:
                if reader is not None:
                    reader.close()
                reader = frames.ShardReader(row["file"])
            content, counts = reader.read(row["frame"]), np.array(row["counts"], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            if bounds[-1] * 4 != len(content):
                raise ValueError(f"{row['file']}: frame {row['frame']} does not hold its documents")
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * len(counts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                 pa.array(row["start_in_shard"] + bounds[:-1], pa.int64()),
                 pa.array([content[4 * a:4 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                names=["shard", "id", "start_in_shard", "ids"])
    if reader is not None:
        reader.close()


def read_documents(manifest: DataFrame) -> DataFrame:
    """(shard, id, start_in_shard, ids as bytes) of the documents in the manifest's frames, read from the files.

    Filter the manifest first (``array_contains(doc_ids, 7)``) to decompress only the frames wanted.
    """
    return manifest.select("shard", "file", "frame", "doc_ids", "counts", "start_in_shard").mapInArrow(
        _read_batches, "shard int, id bigint, start_in_shard bigint, ids binary")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """(shard, base): the ids in all shards before; one row per shard is summed in order."""
    totals = manifest.groupBy("shard").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back: place, length and checksum of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_shards(docs, shared_path(spark, "token-files"), public_tokenizers.path(WORD_BPE))
    read = read_documents(manifest).withColumns(
        {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_crc32": F.crc32("ids")})
    return read.join(shard_starts(manifest), "shard").select(
        F.col("id").alias("doc_id"), (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
