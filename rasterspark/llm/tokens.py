"""Token ids in files of range-coded blocks.

Documents are range-partitioned by id and sorted; a task encodes its documents' words to ids and writes files
of about ``FILE_IDS`` ids, so the files in order of their part hold all ids in ascending document order. A file is a row of
independent blocks (see rangecoder), then the documents' ids and lengths, compressed, with their checksum
and place in the last bytes. Tasks name their files anew at each attempt and only the names that a task
returned are read, so a lost or repeated task leaves nothing behind that counts.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shared_dir, small_batches
from .rangecoder import BLOCK, IDS, block_size, decode_block, encode_block

END, GATHER, FILE_IDS = 2, 4 << 20, 1 << 26
#: Files of one task, for the numbers of parts.
_PER_TASK = 1 << 20
_TAIL = "<QQIII4s"  # start and size of the table, its crc32, documents, of these with null id, magic
_MAGIC = b"RSTF"
# The vocabulary's word-end mark and its way to cut texts, which ``WordIds`` relies on.
_WORD_END = "</w>"
_CUTS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
#: A word of Latin letters with marks before and after it; no apostrophe, which may be cut with letters behind it.
_SIMPLE = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@\[-`{-~]*)")
#: What most words that aren't letters only end in.
_STOPS = frozenset(".,;:!?")
#: Latin letters beyond ASCII as the two characters that byte-level vocabularies have for their bytes.
_BYTES = {c: "".join(chr(b if b > 160 and b != 173 else 323 if b == 173 else 162 + b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
_loaded: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _split(texts: pa.Array) -> pa.ListArray:
    """Words at ASCII white space. A to Z are lower-cased, as the vocabulary does, but not where a special token might come of it."""
    texts = pc.fill_null(texts, "")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


class WordIds:
    """Ids of whole texts by way of a bounded memory of words.

    Where the vocabulary's pre-tokenizer never joins anything across white space, a text's ids are those of its words in
    turn; each new word goes to the library once, many in one call. Beyond ``LIMIT`` words those of the texts at hand are kept. Any other vocabulary gets whole texts.
    """

    LIMIT = 1_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        if self.tokenizer.get_vocab_size() > IDS:
            raise ValueError(f"ids must be below {IDS}")
        steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [parts["pre_tokenizer"]])
        lower = any(n["type"] == "Lowercase" for n in (parts["normalizer"] or {}).get("normalizers", [parts["normalizer"] or {"type": None}]))
        model = parts["model"]
        self.by_word = lower and bool(steps) and steps[0] == _CUTS and steps[-1]["type"] == "ByteLevel" and parts["model"].get("end_of_word_suffix") == _WORD_END
        if self.by_word:
            bare = models.BPE(model["vocab"], [tuple(m) for m in model["merges"]], end_of_word_suffix=_WORD_END, cache_capacity=0)
            self.model = Tokenizer(bare)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(IDS, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(_WORD_END)]] = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _learn(self, words: list[bytes]) -> None:
        """Ask the library for words that are new.

        A simple word has up to three pieces, each of which ends with an id that carries the word-end mark. Such words go to
        the vocabulary's model many in a line, spaces between their pieces, and are told apart by these marks. All others, what
        may hold a special token among them, go to the library one by one.
        """
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        start, size, flat, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [self.flat], len(self.flat)
        many: list[int] | np.ndarray = []
        lines, pieces, alone = [], [], []
        for i, t in enumerate(texts):
            if (plain := t.isascii()) and t.isalpha():
                lines.append(t.lower())
                pieces.append(1)
            elif plain and t[-1:] in _STOPS and t[:-1].isalpha():
                lines.append(f"{t[:-1]} {t[-1]}".lower())
                pieces.append(2)
            elif "<|" not in t and (m := _SIMPLE.fullmatch(t)):
                parts = [x for x in m.groups() if x]
                line = " ".join(parts).lower()
                lines.append(line if plain else line.translate(_BYTES))
                pieces.append(len(parts))
            else:
                alone.append(i)
                continue
            many.append(i)
        many, pieces = np.array(many, np.int64), np.array(pieces, np.int64)
        for k in range(0, len(many), 2000):
            part = many[k : k + 2000]
            got = np.array(self.model.encode_batch_fast([" ".join(lines[k : k + 2000])], add_special_tokens=False)[0].ids, np.uint16)
            cut, last = np.flatnonzero(self.ends[got]) + 1, np.cumsum(pieces[k : k + 2000]) - 1
            if len(cut) != last[-1] + 1 or cut[-1] != len(got):
                alone += part.tolist()
                continue
            size[part] = np.diff(cut[last], prepend=0)
            start[part] = n + cut[last] - size[part]
            flat.append(got)
            n += len(got)
        for k in range(0, len(alone), 500):
            part = alone[k : k + 500]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                got = np.array(e.ids, np.uint16)
                start[i], size[i] = n, len(got)
                flat.append(got)
                n += len(got)
        self.flat, self.start, self.size = np.concatenate(flat), np.concatenate([self.start, start]), np.concatenate([self.size, size])

    def encode(self, texts: pa.Array, end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of each text's."""
        if self.by_word:
            ids, counts = self._encode_words(texts)
        else:
            got = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)]
            ids, counts = np.concatenate([np.zeros(0, np.uint16), *got]), np.array(list(map(len, got)), np.int64)
        if end is not None:
            ids = np.insert(ids, np.cumsum(counts), end)
            counts = counts + 1
        return ids, counts

    def _keep(self, words: list[bytes]) -> None:
        """Forget all but ``words``."""
        known = [w for w in words if w in self.index]
        at = np.fromiter(map(self.index.__getitem__, known), np.int64, len(known))
        size, start = self.size[at], self.start[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        self.flat = self.flat[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]
        self.index, self.start, self.size = dict(zip(known, range(len(known)))), upto[:-1], size

    def _encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = _split(texts)
        words = split.flatten().dictionary_encode()
        kinds = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.index) > self.LIMIT:
            self._keep(kinds)
        at = np.fromiter(map(self.index.get, kinds, itertools.repeat(-1)), np.int64, len(kinds))
        places = [i for i in np.flatnonzero(at < 0).tolist() if kinds[i]]
        if places:
            new, known = [kinds[i] for i in places], len(self.index)
            at[places] = np.arange(known, known + len(new))
            self.index.update(zip(new, range(known, known + len(new))))
            self._learn(new)
        # the splitter gives an empty word for white space at either end
        size, start = (np.where(at >= 0, x[at], 0) if len(x) else np.zeros(len(at), np.int64) for x in (self.size, self.start))
        word = np.asarray(words.indices)
        size, start = size[word], start[word]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])]
        offsets = np.asarray(split.offsets)
        return ids, upto[offsets[1:] - offsets[0]] - upto[offsets[:-1] - offsets[0]]


def _word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def _gathered(batches, gather: int):
    """Batches put together up to some ``gather`` bytes of text."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= gather:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class _File:
    """A file being written: whole blocks go out as they fill; documents' ids and lengths, and the last block, at the end."""

    def __init__(self, folder: str, part: int, block: int):
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(path, recursive=True)
        name = f"part-{part:012d}-{uuid.uuid4().hex}.rstf"
        self.part, self.block, self.url, self.out = part, block, f"{folder}/{name}", self.fs.open_output_stream(f"{path}/{name}")
        self.docs, self.sizes, self.kept, self.n, self.at, self.nulls, self.rows = [], [], np.zeros(0, np.uint16), 0, 0, 0, 0

    def add(self, docs: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.nulls += docs.null_count  # they sort first
        self.rows += len(docs)
        self.docs.append(np.asarray(docs.drop_null(), "<i8"))
        self.sizes.append(counts)
        self.kept = np.concatenate([self.kept, ids])
        self.n += len(ids)
        whole = len(self.kept) // self.block * self.block
        for i in range(0, whole, self.block):
            self.at += self.out.write(encode_block(self.kept[i : i + self.block]))
        self.kept = self.kept[whole:]

    def close(self) -> pa.RecordBatch:
        if len(self.kept):
            self.at += self.out.write(encode_block(self.kept))
        table = zlib.compress(np.concatenate(self.docs).tobytes() + np.concatenate(self.sizes).astype("<u8").tobytes())
        self.out.write(table)
        self.out.write(struct.pack(_TAIL, self.at, len(table), zlib.crc32(table), self.rows, self.nulls, _MAGIC))
        self.out.close()
        return pa.RecordBatch.from_pydict({"part": pa.array([self.part], pa.int64()), "file": [self.url], "n_docs": pa.array([self.rows], pa.int64()), "n_ids": pa.array([self.n], pa.int64())})


def _writer(folder: str, vocabulary: str, block: int, file_ids: int, gather: int):
    def run(batches):
        part, open_file = TaskContext.get().partitionId() * _PER_TASK, None
        for b in _gathered(batches, gather):
            ids, counts = _word_ids(vocabulary).encode(b.column(1))
            open_file = open_file or _File(folder, part, block)
            open_file.add(b.column(0), ids, counts)
            if open_file.n >= file_ids:
                yield open_file.close()
                open_file, part = None, part + 1
        if open_file is not None:
            yield open_file.close()

    return run


def write(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS, gather: int = GATHER) -> DataFrame:
    """Write all rows of ``docs``; returns the files: (part, file, n_docs, n_ids).

    Null texts have the end id only, very long ones run over as many blocks as they need; null ids come first; rows of
    one id go by a hash of their text, so that many of them are still many tasks' work, and repeated rows are written each;
    extra columns are ignored. An empty table gives no files. A file ends with the document that brings it to ``file_ids`` ids or with the texts, ``gather`` bytes at least, that are encoded with it.
    ``folder`` is a URI that executors and driver share; ``vocabulary`` is a file that all can open, of up to 65,536 ids.
    """
    spark = small_batches(docs).sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"), F.monotonically_increasing_id().alias("nr"))
    first = F.col("doc_id").asc_nulls_first()
    rows = rows.repartitionByRange(first, "h", "nr").sortWithinPartitions(first, "h", "text").select("doc_id", "text")
    out = rows.mapInArrow(_writer(folder or shared_dir(spark, "tokens"), vocabulary or default_vocabulary(), block, file_ids, gather), "part long, file string, n_docs long, n_ids long")
    return materialise(out, "token-files")


def _reader(batches):
    for b in batches:
        for part, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            fs, path = pafs.FileSystem.from_uri(file)
            with fs.open_input_file(path) as f:
                end = f.size() - struct.calcsize(_TAIL)
                start, size, crc, n, nulls, magic = struct.unpack(_TAIL, f.read_at(struct.calcsize(_TAIL), end))
                table = f.read_at(size, start)
                if magic != _MAGIC or zlib.crc32(table) != crc:
                    raise ValueError(f"{file} is damaged")
                table = zlib.decompress(table)
                ids = [None] * nulls + np.frombuffer(table, "<i8", n - nulls).tolist()
                counts = np.frombuffer(table, "<u8", n, 8 * (n - nulls)).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(counts)])  # ids before each document
                done, at, seen, crc = 0, 0, 0, 0  # crc: of what there is of a document that goes on
                while at < start:
                    step = block_size(f.read_at(20, at))
                    x = decode_block(f.read_at(step, at))
                    at += step
                    upto = int(np.searchsorted(first, seen + len(x), "right")) - 1
                    crcs = []
                    for s, e in zip(first[done:upto].tolist(), first[done + 1 : upto + 1].tolist()):
                        crcs.append(zlib.crc32(x[max(s - seen, 0) : e - seen].tobytes(), crc))
                        crc = 0
                    crc = zlib.crc32(x[max(int(first[upto]) - seen, 0) :].tobytes(), crc)
                    yield pa.RecordBatch.from_arrays([pa.array([part] * (upto - done), pa.int64()), pa.array(ids[done:upto], pa.int64()), pa.array(first[done:upto]), pa.array(counts[done:upto]), pa.array(crcs, pa.int64())], ["part", "doc_id", "at", "n_tokens", "ids_crc32"])
                    seen, done = seen + len(x), upto
                if seen != first[-1]:
                    raise ValueError(f"{file} holds {'fewer' if seen < first[-1] else 'more'} ids than its table counts")


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``files``, from the files themselves: one row per document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file, no documents
    first = files.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    n = max(1, files.count())
    docs = files.select("part", "file").repartitionByRange(n, "part").mapInArrow(_reader, "part long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
