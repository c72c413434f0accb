"""Token ids in bit-plane files.

Texts are tokenized with a public byte-level BPE, an end id follows each document, and
the id stream is cut into blocks of ``BLOCK`` ids. A block's ids are transposed into
byte planes (all lowest bytes, then all second bytes, ...) or bit planes; every plane is
compressed on its own with zstandard, so the nearly constant high planes cost almost
nothing.

File format (one folder): ``chunks`` is a Parquet table with one row for each block:

    shard, chunk      position; shards ascend with doc_id, chunks count from 0 in a shard
    first, n_ids      first id's position in the shard, and the number of ids
    kind              'byte' or 'bit'
    plane_bytes       compressed length of each plane, lowest plane first
    planes            the compressed planes, one after the other
    doc_ids, doc_ids_in  documents with ids in this block, in order, and how many here
    doc_from          where in the shard the first of them begins (before ``first`` if it continues)

All columns but ``planes`` are the chunk index: a reader that wants some documents or some
id range prunes on them and fetches only the planes it needs. Spark's committer writes the
files, so a lost or repeated task leaves no partial shard. Shard starts are sums
of ``n_ids``: one number for each shard.

Defined results: null text is empty and gives the end id only; an empty table gives an
empty folder; rows that share a doc_id stay separate documents, ordered by a hash of the
text; rows without doc_id come first. Texts of any length: blocks bound what
is held beside one document.
"""

from __future__ import annotations

import re
import zlib
from codecs import charmap_decode
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import common

BLOCK = 1 << 16
LEVEL = 3
# The white space that ends a piece of the vocabulary's own splitting pattern (Unicode White_Space).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_OTHER_SPACE = "\t\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_BLANK = frozenset(["", " ", "\n", *_OTHER_SPACE])
_ODD = f"  | \n|\n |\n\n|[{_OTHER_SPACE}]"
# The vocabulary's splitting pattern inside words, and its letters for bytes (printable Latin-1
# characters stand for themselves, the other bytes for the characters from 256 on, in order).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^ \p{L}\p{N}]+")
_LINED = regex.compile(r"\n|" + _PARTS.pattern.replace("[^ ", r"[^ \n"))
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _SELF]
_LETTERS = "".join(chr(b) if b in _SELF else chr(256 + _OTHERS.index(b)) for b in range(256))
_MARK = b"\xff"          # begins each part given to the library: no byte of UTF-8, so in no merge
_PIECE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

CHUNK = ("shard int, chunk int, first long, n_ids int, kind string, plane_bytes array<int>, planes binary, "
         "doc_ids array<long>, doc_ids_in array<int>, doc_from long")


class Encoder:
    """Ids of whole texts; remembers the ids of words.

    The vocabulary's splitting pattern never joins characters across the start of a single
    space or around a single line feed between other characters, so the ids of a text are
    those of its words, each with the space or line feed before it, in order. Texts with other
    white space are cut by that pattern's white-space rules; texts with an added token's
    string are encoded whole. All words of a call are made distinct in Arrow; those not
    remembered are cut by the pattern, and the library's model encodes each different part once.
    A word's key tells what is before it:

        word            a space
        line feed, word a line feed (or the start of the text, where its id is dropped)
        space, piece    nothing: a piece of a text with other white space

    The ``LIMIT`` words used last are remembered, those above ``LONG`` characters never, so a
    bounded number of bytes is held.
    """

    LIMIT = 500_000       # words remembered
    LONG = 64             # characters of a word that is remembered, at most
    KEYS = 50_000         # new words cut at once
    LIST = 200            # parts in a string given to the library

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)
        mark = _LETTERS[_MARK[0]]
        self._mark = self.whole.token_to_id(mark)
        if any(mark in t and len(t) > 1 for t in self.whole.get_vocab(with_added_tokens=False)):
            raise ValueError("the vocabulary merges a byte that UTF-8 does not have")
        self.model.pre_tokenizer = pre_tokenizers.Split(mark, "merged_with_next")
        self._added = "|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values())
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))

    def _part_ids(self, parts: pa.LargeStringArray) -> pa.LargeListArray:
        """Ids of parts that the splitting pattern leaves whole."""
        lists = pa.LargeListArray.from_arrays([*range(0, len(parts), self.LIST), len(parts)], parts.cast(pa.large_binary()))
        ids = [np.zeros(0, "<u4")]
        for raw in pc.binary_join(lists, pa.scalar(_MARK, pa.large_binary())):
            spelt = charmap_decode(_MARK + raw.as_py(), "strict", _LETTERS)[0]
            ids.append(np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4"))
        marked = np.concatenate(ids)
        marks = marked == self._mark
        begins = np.flatnonzero(marks) - np.arange(len(parts))
        return pa.LargeListArray.from_arrays(np.append(begins, len(marked) - len(parts)), marked[~marks])

    def _key_ids(self, keys: pa.LargeStringArray) -> pa.LargeListArray:
        """Ids of words by their keys."""
        kind = pc.utf8_slice_codeunits(keys, 0, 1)
        fed = pc.equal(kind, "\n")
        bare = pc.or_(pc.equal(kind, " "), pc.equal(kind, ""))
        spaced = keys.filter(pc.invert(pc.or_(fed, bare)))
        # The parts of many keys at once: a line feed goes before each key, and is a part of its own.
        of_spaced = _array(_LINED.findall("".join(["\n " + k for k in _strings(spaced)])))
        of_fed = _array(_LINED.findall("".join(_strings(keys.filter(fed)))))
        of_bare = [_parts(k) for k in _strings(keys.filter(bare))]
        lines = pc.equal(of_spaced, "\n")
        at_spaced, at_fed = (np.flatnonzero(x) for x in (lines, pc.equal(of_fed, "\n")))
        parts = pa.concat_arrays([of_spaced.filter(pc.invert(lines)), of_fed, _array(chain.from_iterable(of_bare))])
        n = len(of_spaced) - len(at_spaced)
        begins = np.concatenate([at_spaced - np.arange(len(at_spaced)), n + at_fed, n + len(of_fed) + _ends([len(p) for p in of_bare])])
        coded = parts.dictionary_encode()
        ids = self._part_ids(coded.dictionary).take(coded.indices)
        ids = pa.LargeListArray.from_arrays(ids.offsets.take(pa.array(begins)), ids.values)
        order = np.concatenate([np.flatnonzero(x) for x in (pc.invert(pc.or_(fed, bare)), fed, bare)])
        return ids.take(pa.array(np.argsort(order)))

    def _word_ids(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and where each word's begin and the last one's end."""
        distinct = coded.dictionary
        place = pc.index_in(distinct, value_set=self.words)
        new = place.is_null()
        keys = distinct.filter(new)
        ids = pa.concat_arrays([self.ids, *(self._key_ids(keys[i:i + self.KEYS]) for i in range(0, len(keys), self.KEYS))])
        unused, at = np.ones(len(self.words), bool), np.empty(len(distinct), np.int64)
        is_new = new.to_numpy(zero_copy_only=False)
        at[~is_new] = place.drop_null()
        unused[at[~is_new]] = False
        at[is_new] = np.arange(len(self.words), len(ids))
        out = ids.take(pa.array(at[coded.indices]))
        short = pc.less_equal(pc.utf8_length(distinct), self.LONG).to_numpy(zero_copy_only=False)
        self.ids = ids.take(pa.array(np.concatenate([at[short], np.flatnonzero(unused)])[:self.LIMIT]))
        self.words = pa.concat_arrays([distinct.filter(short), self.words.filter(unused)])[:self.LIMIT]
        return out.values.to_numpy(), out.offsets.to_numpy()

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        added = pc.match_substring_regex(texts, self._added) if self._added else pa.repeat(pa.scalar(False), len(texts))
        odd = pc.and_not(pc.match_substring_regex(texts, _ODD), added)
        regular = pc.invert(pc.or_(added, odd))
        coded, ends = _coded(texts.filter(regular), texts.filter(odd))
        ids, begins = self._word_ids(coded)
        ends = begins[ends]
        n = pc.sum(regular).as_py() or 0
        out: list[bytes] = [b""] * len(texts)
        order = np.concatenate([np.flatnonzero(regular), np.flatnonzero(odd)])
        for k, (i, a, b) in enumerate(zip(order.tolist(), ends[:-1].tolist(), ends[1:].tolist())):
            out[i] = ids[a + (k < n):b].tobytes()
        for i in np.flatnonzero(added).tolist():
            out[i] = np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes()
        return out


def _coded(regular: pa.LargeStringArray, odd: pa.LargeStringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Keys of all words, and where each text's begin and the last one's end: regular texts, then those with other white space."""
    empty, first = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    cut = pc.split_pattern(pc.binary_join_element_wise(first, pc.replace_substring(regular, "\n", " \n"), empty), " ")
    pieces = [_array([p[1:] if p[0] == " " and p[1:2] not in _BLANK else " " + p for p in _PIECE.findall(t.as_py())]) for t in odd]
    words = pa.concat_arrays([cut.values, *pieces]) if pieces else cut.values
    return words.dictionary_encode(), np.concatenate([cut.offsets, len(cut.values) + _ends([len(p) for p in pieces])[1:]])


def _ends(sizes: np.ndarray | list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _array(strings) -> pa.LargeStringArray:
    return pa.array(strings, pa.large_string())


def _strings(column: pa.LargeStringArray) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _parts(key: str) -> list[str]:
    """Parts of a key that is empty (the text ends with a space) or has nothing before its piece."""
    piece = key[1:] or " "
    return [piece] if piece[0] in _BLANK else _PARTS.findall(piece)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack(ids: np.ndarray, kind: str = "byte", level: int = LEVEL) -> tuple[list[int], bytes]:
    """Compressed planes of a block of ids: their lengths and their bytes, lowest plane first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        planes = np.ascontiguousarray(rows.T)
    elif kind == "bit":
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        raise ValueError(f"unknown kind of plane: {kind}")
    press = zstandard.ZstdCompressor(level=level)
    out = [press.compress(p.tobytes()) for p in planes]
    return [len(x) for x in out], b"".join(out)


def unpack(lengths: list[int], planes: bytes, n: int, kind: str = "byte") -> np.ndarray:
    """The n ids of a block."""
    open_ = zstandard.ZstdDecompressor()
    ends = np.cumsum(lengths)
    raw = [np.frombuffer(open_.decompress(planes[e - k:e]), np.uint8) for k, e in zip(lengths, ends)]
    if kind == "byte":
        rows = np.stack(raw, axis=1)
    else:
        bits = np.unpackbits(np.stack(raw), axis=1, count=n, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").ravel()


_CHUNK_TYPE = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("kind", pa.string()),
                         ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                         ("doc_ids_in", pa.list_(pa.int32())), ("doc_from", pa.int64())])
GROUP = 8 << 20           # bytes of text encoded at once, but for one text above it


def _groups(batches, limit: int = GROUP):
    """doc_ids and texts of following rows together, whatever the batches are: ``limit`` bytes, and one row above it at most."""
    held, total, now = [], 0, 0
    for batch in batches:
        sizes = 16 + pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
        group = (total + np.cumsum(sizes) - sizes) // limit
        total += int(sizes.sum())
        starts = np.flatnonzero(np.diff(group, prepend=now)).tolist()
        for a, b in zip([0, *starts], [*starts, batch.num_rows]):
            if a in starts and held:
                yield _rows(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
                now = group[b - 1]
    if held:
        yield _rows(held)


def _rows(held: list[pa.RecordBatch]) -> tuple[list[int], pa.Array]:
    docs, texts = (pa.concat_arrays([b.column(i) for b in held]) for i in (0, 1))
    return docs.to_pylist(), pc.fill_null(texts.cast(pa.large_string()), "")


def _encode(batches, path: str, end_id: int, block: int, kind: str, level: int):
    """Chunks of one shard: the partition's documents in their order."""
    from pyspark import TaskContext

    shard, chunk, first = TaskContext.get().partitionId(), 0, 0
    held, docs, sizes, doc_from, n = [], [], [], 0, 0
    end = np.array([end_id], "<u4").tobytes()

    def cut():
        lengths, planes = pack(np.frombuffer(b"".join(held), "<u4"), kind, level)
        return pa.RecordBatch.from_pylist([dict(zip(_CHUNK_TYPE.names, (shard, chunk, first, n, kind, lengths, planes, docs, sizes, doc_from)))], schema=_CHUNK_TYPE)

    for some, texts in _groups(batches):
        for doc, raw in zip(some, encoder(path)(texts)):
            raw, at, begin = raw + end, 0, first + n
            while at < len(raw):
                part = raw[at:at + 4 * (block - n)]
                held.append(part)
                docs.append(doc)
                sizes.append(len(part) // 4)
                at += len(part)
                n += len(part) // 4
                if n == block:
                    yield cut()
                    chunk, first = chunk + 1, first + n
                    held, docs, sizes, n, doc_from = [], [], [], 0, begin if at < len(raw) else first
    if n:
        yield cut()


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, block: int = BLOCK, kind: str = "byte", level: int = LEVEL) -> None:
    """Encode the whole texts of ``docs`` (doc_id, text) in ascending doc_id order into files under ``path``."""
    tie = F.xxhash64(common.text_or_empty())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())     # equal rows are dealt over several tasks
    rows = rows.repartitionByRange("doc_id", tie, "__tie").sortWithinPartitions("doc_id", tie).drop("__tie")
    coded = rows.mapInArrow(partial(_encode, path=vocabulary, end_id=end_id, block=block, kind=kind, level=level), CHUNK)
    coded.write.option("compression", "none").parquet(f"{path}/chunks")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK).parquet(f"{path}/chunks")


def _pieces(batches):
    """Per document and block: where the document begins in its shard, the part's place, ids and crc32."""
    for batch in batches:
        out = []
        for row in zip(*batch.columns):
            shard, first, n, kind, lengths, planes, docs, sizes, doc_from = (x.as_py() for x in row)
            raw, at = unpack(lengths, planes, n, kind).tobytes(), 0
            for k, (doc, size) in enumerate(zip(docs, sizes)):
                out.append((shard, doc, first + at if k else doc_from, first + at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                at += size
        yield _table(out, _PIECES)


def _joined(batches):
    """Documents from their parts in order."""
    for batch in batches:
        out = []
        for start, doc, parts in zip(*batch.columns):
            start, doc, parts, crc, n = start.as_py(), doc.as_py(), parts.as_py(), 0, 0
            for part in parts:
                crc, n = crc_join(crc, part["crc"], 4 * part["n"]), n + part["n"]
            out.append((doc, start, n, crc))
        yield _table(out, _DIGEST)


def _table(rows: list[tuple], columns: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in columns.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], {"int": pa.int32(), "long": pa.int64()}[t]) for i, t in enumerate(types)], names=list(names))


_PIECES = "shard int, doc_id long, begin long, at long, n long, crc long"
_DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


def crc_join(a: int, b: int, n: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the second's length."""
    power = [0xEDB88320] + [1 << i for i in range(31)]      # one zero bit
    for _ in range(3):
        power = [_times(power, p) for p in power]
    while n:
        if n & 1:
            a = _times(power, a)
        power = [_times(power, p) for p in power]
        n >>= 1
    return a ^ b


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (over all documents), n_tokens, ids_crc32.

    Blocks are decoded where they lie; only one short row for each document and block is
    shuffled, and the parts of a document are joined by their checksums.
    """
    chunks = read_chunks(spark, path)
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()   # one row a shard
    starts, total = [], 0
    for shard, n in sorted((r[0], r[1]) for r in sizes):
        starts.append((shard, total))
        total += n
    base = F.broadcast(spark.createDataFrame(starts, "shard int, base long"))
    pieces = (chunks.select("shard", "first", "n_ids", "kind", "plane_bytes", "planes", "doc_ids", "doc_ids_in", "doc_from")
              .mapInArrow(_pieces, _PIECES).join(base, "shard")
              .select((F.col("base") + F.col("begin")).alias("start"), "doc_id", "at", "n", "crc"))
    # A document's parts: one for each block that it reaches into.
    docs = (pieces.groupBy("start", "doc_id")
            .agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts")))
    one = docs.where(F.size("parts") == 1).select("doc_id", "start", F.col("parts")[0]["n"].alias("n_tokens"), F.col("parts")[0]["crc"].alias("ids_crc32"))
    return one.unionByName(docs.where(F.size("parts") > 1).select("start", "doc_id", "parts").mapInArrow(_joined, _DIGEST))
