"""Token ids as flat binary files that are memory-mapped.

Documents are range-partitioned by doc_id; each task encodes its texts whole and
writes two files into a shared folder as it goes:

``ids``   the ids of all its documents, one after the other, little-endian
          unsigned integers (16 bits where the vocabulary allows, else 32);
``index`` a table of one record per document (64-bit offset of its first id in
          the file, number of ids, doc_id, whether doc_id is known), 64-bit each.

Files of lost attempts are never named by the manifest: it holds what the tasks
that ended have returned, one row per task, and is kept before it is used. The
place of a file's first id in the whole corpus is the prefix sum of the ids in
the files before it. Reading maps both files into memory, so a document costs
the pages it covers.

Encoding cuts a text before white space that follows a visible character, where
the pre-tokeniser cuts in any case, gives the words of each piece to the library's
model, and remembers the ids of the pieces (at most ``REMEMBER`` of them, until a worker has had
nothing to write for ``IDLE`` seconds); texts with rare white space, with the start of a special token or with any added token of
the file are encoded as they are. Ids are those of ``Tokenizer.encode`` on the whole text.

Defined cases: a null text is an empty one (the end id alone); a null doc_id
sorts first; repeated rows are written each; rows of one doc_id lie in the order of a hash of
their texts, so that those with different texts may be dealt over tasks; an
empty table gives no files and an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import threading
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from runtally.llm.common import drop_folder, materialise, shared_folder, ship

END_ID = 0
REMEMBER = 1 << 19  # pieces whose ids a worker keeps from task to task, about 150 bytes each
IDLE = 3.0  # seconds after a task; then a worker without a new one forgets them
LONG = 64  # characters of the longest piece that is kept
# White space that str and the pre-tokeniser may see differently, or the start of a special token.
RARE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff]|<\\|")
PIECE = re.compile(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+")
# Fixed value: the public pattern of the byte-level pre-tokeniser.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
RECORD = 4  # 64-bit fields of an index record


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in a byte-level vocabulary: printable bytes for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as packed little-endian bytes.

    A byte-level BPE file without normaliser is used through its model, word by
    word of its pre-tokeniser; any other file through ``encode`` on the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        setup = json.loads(self.tokenizer.to_str())
        pre, model = setup.get("pre_tokenizer") or {}, setup.get("model") or {}
        self.by_word = (model.get("type") == "BPE" and not model.get("dropout") and setup.get("normalizer") is None
                        and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.model = self.tokenizer.model
        added = [t["content"] for t in setup.get("added_tokens") or [] if t["content"]]
        self.rare = re.compile("|".join([RARE.pattern, *map(re.escape, added)]))
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.timer: threading.Timer | None = None

    def begin(self) -> None:
        """A task begins: what is known stays."""
        if self.timer is not None:
            self.timer.cancel()
            self.timer = None

    def end(self) -> None:
        """A task has ended: unless another one begins soon, this worker's memory is left to other stages."""
        self.timer = threading.Timer(IDLE, self.known.clear)
        self.timer.daemon = True
        self.timer.start()

    def _packed(self, ids: list[int]) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder == "big":
            a.byteswap()
        return a.tobytes()

    def _word(self, word: str) -> bytes:
        return self._packed([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))])

    def _piece(self, piece: str) -> bytes:
        spaced = piece[0] == " "
        body = piece[1:] if spaced else piece
        if body.isalpha():  # one word, as most pieces are
            if body.isascii():
                return self._packed([t.id for t in self.model.tokenize(self.letters[32] + body if spaced else body)])
            return self._word(piece)
        known = self.known
        return b"".join([known.get(w) or self._word(w) for w in WORD.findall(piece)])

    def encode(self, text: str) -> bytes:
        if not self.by_word or self.rare.search(text):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = PIECE.findall(text)
        known = self.known
        new = {p: self._piece(p) for p in set(pieces).difference(known)}
        known.update(new)
        out = b"".join(map(known.__getitem__, pieces))
        # a full memory stays as it is: what comes first is what comes often
        full = len(known) > REMEMBER
        for p in new:
            if full or len(p) > LONG:
                del known[p]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:/") else f"file://{folder}")


def _writer(path: str, folder: str, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (store, root) = encoder(path), _filesystem(folder)
        enc.begin()
        end = np.array([end_id], enc.dtype).tobytes()
        name = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        at, docs, ids, index = 0, 0, None, None
        for b in batches:
            if b.num_rows == 0:
                continue
            if ids is None:
                ids, index = store.open_output_stream(name + ".ids"), store.open_output_stream(name + ".index")
            records = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                data = enc.encode(text.as_py() or "") + end
                n = len(data) // enc.dtype.itemsize
                ids.write(data)
                records.append((at, n, doc_id or 0, int(doc_id is not None)))
                at += n
            index.write(np.array(records, "<i8").tobytes())
            docs += len(records)
        enc.end()
        if ids is not None:
            ids.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "file": name, "docs": docs, "ids": at,
                                               "width": enc.dtype.itemsize, "folder": folder}])

    return task


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Writes the files; returns the manifest: part, file, docs, ids, width, folder, base.

    ``tokenizer``: path of a tokenizer file that all executors have. Without a ``folder`` the
    files go to one in the shared folder that is deleted when the session ends.
    """
    spark = docs.sparkSession
    ship(spark)
    if folder is None:
        folder = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
        drop_folder(spark, folder, at_end=True)
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("place", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").drop("place")
    manifest = materialise(ordered.mapInArrow(_writer(tokenizer, folder, end_id),
                                              "part long, file string, docs long, ids long, width long, folder string"))
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _reader():
    def mapped(store, name: str, dtype: str) -> np.ndarray:
        if isinstance(store, pafs.LocalFileSystem):
            return np.memmap(name, dtype, "r")
        with store.open_input_file(name) as f:
            return np.frombuffer(f.read(), dtype)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                store, _ = _filesystem(m["folder"])
                ids = mapped(store, m["file"] + ".ids", f"<u{m['width']}")
                index = mapped(store, m["file"] + ".index", "<i8").reshape(-1, RECORD)
                for k in range(0, len(index), 4096):
                    part = np.array(index[k:k + 4096])
                    crc = [zlib.crc32(ids[a:a + n].astype("<u4").tobytes()) for a, n in part[:, :2].tolist()]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(part[:, 2], mask=part[:, 3] == 0), pa.array(part[:, 0] + m["base"]), pa.array(part[:, 1]),
                        pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return task


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    spark: SparkSession = manifest.sparkSession
    files = manifest.count()
    spread = manifest.repartition(max(1, files), "part")
    return spread.mapInArrow(_reader(), "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(store_file: str, width: int, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of a local ids file, through a memory map."""
    return np.memmap(store_file, f"<u{width}", "r")[start:start + n]
