"""Encode documents, write the ids as files of directly addressable codes, read them back."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import scratch_path, written_table
from urbanflux.llm.dac import Codes, document_ids, pack

#: Appended to every document.
END_ID = 0
#: A file is closed once it holds so many ids.
FILE_IDS = 4_000_000
#: Most tasks that read files; with more files each task reads several, one after another.
MOST_READERS = 10_000
#: Characters of text that are split and looked up together.
CHARACTERS = 4_000_000
#: Encoded words of a worker's newer generation; once it is full it becomes the older one.
REMEMBERED = 300_000
#: A blank that does not stand between two visible characters; any white space of Unicode counts.
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Letters (all of them in \\p{L}) and marks (none of them an apostrophe) at whose borders the word pattern always cuts.
_LETTERS, _MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
#: A word of letters and marks, with line breaks that stand alone between them; and its pieces.
_CUT = re.compile(f"[{_LETTERS}{_MARKS}]+(?:\n[{_LETTERS}{_MARKS}]+)*")
_PIECES = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+|\n")
_ODD_BLANK = f"{_WHITE} | {_WHITE}|^ | $"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of a plain path."""
    uri = path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


class Encoder:
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    The vocabulary's word pattern never joins a visible character with a blank behind
    it, so a text may be cut before each blank that stands between two visible
    characters. Words that are not remembered are encoded in one call, one blank before
    each; since no other token begins with a blank, the ids fall apart again at tokens
    that do. A text with other blanks, or a word with a special token's name, is left to
    the library as it is. A word of letters, marks and single line breaks is put together
    from these pieces, which are far fewer than such words; the first is a word itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        size = self.tokenizer.get_vocab_size(True)
        self.blank = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = int(self.tokenizer.token_to_id("Ċ"))
        # Two generations: a word still in use moves to the newer one, the others are dropped with the older.
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"\n": np.array([self.newline], "<u4").tobytes()}  # pieces without a blank before them

    def _ids(self, text: str) -> np.ndarray:
        # The batch call for ids alone: it keeps no offsets of the tokens in the text.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of `` word`` for each word."""
        if len(self.newer) > REMEMBERED:
            self.older, self.newer = self.newer, {}
        if len(self.tails) > REMEMBERED:
            self.tails = {"\n": self.tails["\n"]}
        # Words to encode, and pieces of words to put together.
        unknown, cut, tails = {}, [], {}
        for w in words:
            if w not in self.newer and not self._kept(w):
                if not w.isalpha() and _CUT.fullmatch(w) and len(pieces := _PIECES.findall(w)) > 1:
                    cut.append((w, pieces))
                    if pieces[0] not in self.newer and not self._kept(pieces[0]):
                        unknown[pieces[0]] = None
                    for piece in pieces[1:]:
                        if piece not in self.tails:
                            tails[piece] = None
                else:
                    unknown[w] = None
        unknown, tails = list(unknown), list(tails)
        for lo in range(0, len(unknown), 2000):
            part = unknown[lo : lo + 2000]
            ids = self._ids(" " + " ".join(part))
            cuts = np.flatnonzero(self.blank[ids]).tolist() + [len(ids)]
            if len(cuts) != len(part) + 1:
                raise AssertionError("words and ids don't match")
            data = ids.tobytes()
            for word, a, b in zip(part, cuts, cuts[1:]):
                self.newer[word] = data[4 * a : 4 * b]
        for lo in range(0, len(tails), 2000):
            part = tails[lo : lo + 2000]
            for piece, ids in zip(part, self._openings(part)):
                self.tails[piece] = ids.tobytes()
        for w, (first, *rest) in cut:
            self.newer[w] = self.newer[first] + b"".join([self.tails[t] for t in rest])

    def _kept(self, word: str) -> bool:
        """Whether the older generation has the word, which then moves to the newer one."""
        ids = self.older.get(word)
        if ids is not None:
            self.newer[word] = ids
        return ids is not None

    def _openings(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words that begin a text, all in one call with a line break between them."""
        apart = [w for w in words if not w or w != "".join(w.split())]
        if apart:
            return [self._ids(w) for w in words]
        ids = self._ids("\n".join(words))
        cuts = np.flatnonzero(ids == self.newline)
        if len(cuts) != len(words) - 1:
            raise AssertionError("words and ids don't match")
        return np.split(ids, np.stack([cuts, cuts + 1], 1).ravel())[::2]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD_BLANK).to_pylist()
        plain = [bool(t) and not o and not any(s in t for s in self.special) for t, o in zip(texts, odd)]
        out: list[np.ndarray | None] = [None if p else self._ids(t) for p, t in zip(plain, texts)]
        rows = [i for i, p in enumerate(plain) if p]
        if rows:
            for i, ids in zip(rows, self._encode_plain([texts[i] for i in rows])):
                out[i] = ids
        return out

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self._learn(words)
        held = pa.array(list(map(self.newer.__getitem__, words)), pa.large_binary())
        # Arrow puts the bytes of all words one after another; offsets count bytes.
        taken = held.take(coded.indices)
        _, places, data = taken.buffers()
        places = np.frombuffer(places, np.int64, len(taken) + 1) // 4
        ids = np.frombuffer(data, "<u4", places[-1])
        ends = places[offsets[1:]]
        # The first word has no blank before it.
        openings = self._openings([t.split(" ", 1)[0] for t in texts])
        begins = places[offsets[:-1] + 1]
        return [np.concatenate([o, ids[a:b]]) for o, a, b in zip(openings, begins, ends)]


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    """One per worker process: later tasks find the words of earlier ones."""
    return Encoder(vocabulary)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHARACTERS:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all texts in ascending order of doc_id; returns the table of files.

    Documents are dealt by range of (doc_id, hash of the text), null ids first, so that
    a repeated id may fill several files; each task sorts its range and encodes it slice
    by slice. A file is closed once it holds ``file_ids`` ids, so a task holds one file and
    one slice however long its range is; only a document that is longer fills a longer file.
    A file is named by its range and its number there, and gets that name at its end,
    so a repeated task leaves the same files. Null texts count as empty, texts of any length
    are encoded whole; every document ends with END_ID. Empty ranges write no file. Columns beside
    doc_id and text, whatever their names, are not read. Returned: file (number, in order), path,
    documents, ids and before (ids of all files before).
    """
    target = folder.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary)
        context = TaskContext.get()
        system, place = store(target)
        doc_ids, known, ids, held, closed = [], [], [], 0, 0

        def close() -> pd.DataFrame:
            nonlocal held, closed
            name = f"tokens-{context.partitionId():06d}-{closed:06d}.dac"
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            data = pack(np.concatenate(ids), np.array(doc_ids, np.int64), np.array(known, bool), starts)
            system.create_dir(place, recursive=True)
            with system.open_output_stream(f"{place}/{name}.{context.taskAttemptId()}.part") as out:
                out.write(data)
            system.move(f"{place}/{name}.{context.taskAttemptId()}.part", f"{place}/{name}")
            row = {"range": context.partitionId(), "part": closed, "name": name, "documents": len(ids), "ids": held}
            doc_ids.clear(), known.clear(), ids.clear()
            held, closed = 0, closed + 1
            return pd.DataFrame([row])

        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in _slices(texts):
                encoded = encoder.encode(texts[lo:hi])
                for doc_id, is_known, part in zip(batch["doc_id"][lo:hi].tolist(), batch["known"][lo:hi].tolist(), encoded):
                    doc_ids.append(doc_id)
                    known.append(is_known)
                    ids.append(np.append(part, END_ID).astype("<u4"))
                    held += len(part) + 1
                    if held >= file_ids:
                        yield close()
        if ids:
            yield close()

    rows = docs.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNotNull().alias("known"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("known"), F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written_table(dealt.mapInPandas(run, "range int, part int, name string, documents long, ids long"), "token_files")
    return _placed(parts, target)


def _placed(parts: DataFrame, target: str) -> DataFrame:
    """Number and ``before`` of each file: sums over ranges first, so that no window holds all files."""
    ranges = parts.groupBy("range").agg(F.count(F.lit(1)).alias("files"), F.sum("ids").alias("all_ids"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "range", F.coalesce(F.sum("files").over(earlier), F.lit(0)).alias("files_before"),
        F.coalesce(F.sum("all_ids").over(earlier), F.lit(0)).alias("ids_before"),
    )
    within = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("ids").over(within), F.lit(0))
    return parts.withColumn("inside", inside).join(ranges, "range").select(
        (F.col("files_before") + F.col("part")).alias("file"), F.concat(F.lit(target + "/"), "name").alias("path"),
        "documents", "ids", (F.col("ids_before") + F.col("inside")).alias("before"),
    )


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files, read from the files alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"]):
                system, place = store(path)
                with system.open_input_stream(place) as stream:
                    codes = Codes(stream.read())
                starts = codes.starts
                data = memoryview(codes.span(0, codes.n_ids)).cast("B")
                yield pd.DataFrame({
                    "doc_id": pd.arrays.IntegerArray(codes.doc_ids.astype(np.int64), ~codes.known), "start": starts[:-1] + int(before), "n_tokens": np.diff(starts),
                    "ids_crc32": [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), starts[1:].tolist())],
                })

    # A file holds few ids more than one file_ids, so a task's memory does not depend on how many it reads.
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, min(files.count(), MOST_READERS))
    return files.select("path", "before").repartition(tasks, "path").mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_of(path: str, number: int) -> np.ndarray:
    """Ids of the document at place ``number`` of a file; only the bytes that hold them are read."""
    system, place = store(path)
    with system.open_input_file(place) as file:
        return document_ids(file.read_at, number)


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
