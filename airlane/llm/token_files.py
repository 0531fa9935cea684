"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record file holds, per document in ascending id order, a frame: the payload's length (8 bytes), the
masked checksum of these 8 bytes (4), the payload, and the payload's masked checksum (4), all little
endian. A payload is the document id (8 bytes), a flag byte (bit 0: the id is null, bit 1: ids take 4
bytes instead of 2) and the token ids. The masked checksum of c is ((c >> 15 | c << 17) + 0xa282ead8)
mod 2**32, c a CRC-32. Beside every record file stands its index, one 8-byte offset per frame.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlane.llm.common import prepare, scratch, stored, text_hash

#: A record file is closed beyond this many bytes.
FILE_BYTES = 64 << 20
#: Entries of a worker's cache of encoded words; it is emptied when full. Its longest word in bytes.
CACHE_ROWS, _LONG_WORD = 1_200_000, 48
#: Bytes of texts that are split at a time; a longer text is split alone.
RUN_BYTES = 4 << 20
#: Printable ASCII and Latin letters that normalisation leaves alone but for their case.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(stream) -> Iterator[bytes]:
    """Payloads of a record stream; a wrong length or checksum raises."""
    while head := stream.read(12):
        if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
            raise ValueError("damaged record length")
        (n,) = struct.unpack("<Q", head[:8])
        body = stream.read(n + 4)
        if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
            raise ValueError("damaged record payload")
        yield body[:n]


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return struct.pack("<qB", doc_id or 0, (doc_id is None) | wide << 1) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = struct.unpack_from("<qB", payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype(np.uint32)


class WordEncoder:
    """Ids of whole texts; words between ASCII white space are encoded once and remembered.

    A batch is lower-cased (A-Z), split and dictionary-encoded by Arrow; its distinct words are looked up
    in flat arrays of ids, and the ids of all its words gathered at once. Holds for tokenizers that lower
    case and drop white space before they split, which is tested on the file itself; texts that could
    hold a special string are encoded whole. New words of printable ASCII and Latin letters are cut by
    the tokenizer's own pattern, and the parts given to its merges directly; other words go through
    the library whole.
    """

    def __init__(self, path: str, cache_rows: int = CACHE_ROWS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache_rows = cache_rows
        self.forget()
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = one(" Ab,\n\tc\r\x0b\x0cd") == [i for t in ("ab", ",", "c", "d") for i in one(t)]
        self.parts = self._pattern()
        self.model = self.tokenizer.model
        self.alphabet = ByteLevel(add_prefix_space=False, use_regex=False)

    def _pattern(self):
        """The pattern that cuts a word, if that and a byte-level alphabet are all the tokenizer does before its merges."""
        made = json.loads(self.tokenizer.to_str())
        cut = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        steps = [n.get("type") for n in (made["normalizer"] or {}).get("normalizers") or []]
        plain = (steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cut] == ["Split", "ByteLevel"]
                 and cut[0].get("behavior") == "Removed" and cut[0].get("invert") and "Regex" in cut[0].get("pattern", {})
                 and not cut[1].get("add_prefix_space") and not cut[1].get("use_regex")
                 and made["model"].get("type") == "BPE" and not made["model"].get("dropout"))
        return regex.compile(cut[0]["pattern"]["Regex"]) if plain and self.by_word else None

    def forget(self) -> None:
        """An empty memory: words' slots, and where each slot's ids stand."""
        self.slot: dict[str, int] = {}
        self.flat, self.begin = np.empty(1 << 12, dtype="<u4"), np.zeros(1 << 10, dtype=np.int64)
        self.slots = 0

    def _put(self, lists: list[list[int]]) -> int:
        """Append a slot for each list of ids; the number of the first."""
        first = self.slots
        ends = self.begin[first] + np.cumsum([len(x) for x in lists], dtype=np.int64)
        for name, size in (("begin", first + len(lists) + 1), ("flat", int(ends[-1]) if len(ends) else 0)):
            if size > len(held := getattr(self, name)):
                setattr(self, name, np.concatenate([held, np.empty(max(size - len(held), len(held)), dtype=held.dtype)]))
        self.begin[first + 1:first + 1 + len(lists)] = ends
        if len(ends):
            self.flat[self.begin[first]:ends[-1]] = [i for x in lists for i in x]
        self.slots += len(lists)
        return first

    def _merged(self, part: str) -> list[int]:
        """Ids of a part between cuts, straight from the model."""
        if not part.isascii():
            part = "".join(p for p, _ in self.alphabet.pre_tokenize_str(part))
        return [t.id for t in self.model.tokenize(part)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[list[int]]:
        """Ids of new words without white space."""
        cut = [self.parts.findall(w.lower()) if self.parts and _PLAIN.fullmatch(w) else None for w in words]
        whole = iter(self.encode([w for w, parts in zip(words, cut) if parts is None]))
        here: dict[str, list[int]] = {}
        for part in {p for parts in cut if parts for p in parts}:
            at = self.slot.get(part)
            here[part] = (self.flat[self.begin[at]:self.begin[at + 1]].tolist() if at is not None else self._merged(part))
        return [next(whole) if parts is None else [i for p in parts for i in here[p]] for parts in cut]

    def _slots(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Slots of distinct words, learning the new ones, and how many slots to keep afterwards."""
        get = self.slot.get
        at = np.array([get(w, -1) for w in words], dtype=np.int64)
        new = np.flatnonzero(at < 0)
        if len(self.slot) + len(new) > self.cache_rows:
            self.forget()
            new = np.arange(len(words))
        # Long words are not remembered: their slots stand last and are given up.
        new = np.array(sorted(new.tolist(), key=lambda i: len(words[i]) > _LONG_WORD), dtype=np.int64)
        first = self._put(self._learn([words[i] for i in new.tolist()]))
        at[new] = np.arange(first, first + len(new))
        short = sum(len(words[i]) <= _LONG_WORD for i in new.tolist())
        self.slot.update((words[i], first + k) for k, i in enumerate(new[:short].tolist()))
        return at, first + short

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        at, keep = self._slots(coded.dictionary.to_pylist())
        of = at[coded.indices.to_numpy(zero_copy_only=False)]
        begin, size = self.begin[of], self.begin[of + 1] - self.begin[of]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        self.slots = keep
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as 4-byte little-endian integers."""
        ids, begins = self.encoded(pa.array([t.decode() for t in texts], pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])]

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null as empty), one behind the other, and where each begins and, last, all end."""
        # The tokenizer lower-cases; doing that for A-Z first lets spellings share an entry.
        texts = pc.fill_null(texts, "")
        low = pc.ascii_lower(texts)
        whole = np.full(len(texts), not self.by_word)
        for special in self.specials:
            whole |= pc.match_substring(low, special).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_word(low)
        ids, begins = self._by_word(low.filter(pa.array(~whole)))
        parts = iter(np.split(ids, begins[1:-1]) if len(begins) > 1 else ())
        other = iter(self.encode(texts.filter(pa.array(whole)).to_pylist()))
        lists = [np.array(next(other), dtype="<u4") if w else next(parts) for w in whole]
        return np.concatenate(lists), np.cumsum([0, *map(len, lists)])


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> WordEncoder:
    """One encoder per worker process: its cache outlives a task."""
    return WordEncoder(path)


def runs_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about RUN_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cell = (np.cumsum(sizes) - sizes) // RUN_BYTES
    first = np.flatnonzero(np.diff(cell, prepend=-1)).tolist()
    for a, b in zip(first, [*first[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _open(uri: str):
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return system, path


class _Files:
    """Record files of one task. A file appears under its name when whole, so a repeated task replaces it."""

    def __init__(self, uri: str, task: int, attempt: int, limit: int) -> None:
        self.system, self.root = _open(uri)
        self.system.create_dir(self.root, recursive=True)
        self.task, self.attempt, self.limit, self.number, self.out = task, attempt, limit, 0, None

    def write(self, payload: bytes, tokens: int) -> dict | None:
        """Description of the file if it is full now."""
        if self.out is None:
            self.name = f"{self.task:06d}-{self.number:05d}"
            self.part = f"{self.root}/.{self.name}.{self.attempt}"
            self.out, self.offsets, self.size, self.tokens = self.system.open_output_stream(self.part), [], 0, 0
        data = frame(payload)
        self.offsets.append(self.size)
        self.out.write(data)
        self.size += len(data)
        self.tokens += tokens
        return self.close() if self.size >= self.limit else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        with self.system.open_output_stream(self.part + ".index") as index:
            index.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.system.move(self.part + ".index", f"{self.root}/{self.name}.index")
        self.system.move(self.part, f"{self.root}/{self.name}.records")
        self.out, self.number = None, self.number + 1
        return {"file": self.name, "records": len(self.offsets), "bytes": self.size, "tokens": self.tokens}


_FILES = "file string, records long, bytes long, tokens long"
_FILES_ARROW = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("tokens", pa.int64())])


def write_token_files(docs: DataFrame, tokenizer: str, uri: str, end_id: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every whole text and write record files and indexes below ``uri``; returns the file list.

    Documents stand in ascending ``doc_id`` order (null first; rows of one id by their texts' hash) over
    the files in name order. A null text counts as empty, so every document has at least the end id.
    ``file string, records long, bytes long, tokens long``, stored.
    """
    spark = prepare(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long"), "text", text_hash().alias("h"))
               .repartitionByRange(partitions, F.asc_nulls_first("doc_id"), "h")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "h"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        encoder, made = worker_encoder(tokenizer), []
        files = _Files(uri, task.partitionId(), task.taskAttemptId(), file_bytes)
        for batch in batches:
            for run in runs_of(batch):
                ids, begins = encoder.encoded(run.column("text"))
                for doc_id, a, b in zip(run.column("doc_id").to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                    values = np.append(ids[a:b], np.uint32(end_id))
                    made.append(files.write(pack(doc_id, values), len(values)))
        made.append(files.close())
        yield pa.RecordBatch.from_pylist([m for m in made if m], schema=_FILES_ARROW)

    return stored(ordered.mapInArrow(write, _FILES), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame, uri: str) -> DataFrame:
    """Read the files back, each in a task of its own: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before; running sums over the file list give each file's own.
    """
    # Running sums in two steps: over a thousand writing tasks, a row each, and over the files of these.
    many = F.substring("file", 1, 3)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("file", "tokens", many.alias("many"))
    sums = listed.groupBy("many").agg(F.sum("tokens").alias("all")).select(
        "many", F.coalesce(F.sum("all").over(before.orderBy("many")), F.lit(0)).alias("earlier"))
    here = F.coalesce(F.sum("tokens").over(before.partitionBy("many").orderBy("file")), F.lit(0))
    plan = listed.withColumn("here", here).join(sums, "many").select("file", (F.col("earlier") + F.col("here")).alias("base"))
    plan = plan.repartition(max(1, min(files.count(), 10_000)), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(uri)
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows = []
                with system.open_input_stream(f"{root}/{name}.records", buffer_size=1 << 20) as stream:
                    for payload in frames(stream):
                        doc_id, ids = unpack(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], names=names)

    return plan.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_record(uri: str, name: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number in a file, through the offset index: what a shuffled reader does."""
    system, root = _open(uri)
    with system.open_input_file(f"{root}/{name}.index") as index:
        (offset,) = struct.unpack("<Q", index.read_at(8, 8 * number))
    with system.open_input_file(f"{root}/{name}.records") as records:
        records.seek(offset)
        return unpack(next(frames(records)))


def token_files(docs: DataFrame, tokenizer: str, uri: str | None = None, end_id: int = 1) -> DataFrame:
    """Write the record files (below a new scratch folder unless ``uri`` is given) and read them back."""
    spark = docs.sparkSession
    uri = uri or scratch(spark, "token-records")
    return read_token_files(spark, write_token_files(docs, tokenizer, uri, end_id), uri)
