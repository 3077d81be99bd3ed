"""Sequences of bounded length from documents: bounded-space online packing."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Collection, Iterator
from functools import cached_property
from itertools import islice
from string import ascii_lowercase, punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import as_batch
from corpusloom.llm.ngram_join import in_parts
from corpusloom.session import materialize

LENGTH = 2048
OPEN_WINDOWS = 16
END_ID = 1
#: Partitions whose leftovers meet in one task.
MERGED_PARTITIONS = 64
#: Words, and pieces of words, whose ids a worker process remembers while it packs, if the caller sets no other number.
REMEMBERED = 500_000
#: Text that a task cuts into words at a time.
PART_BYTES = 1 << 19

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LOWER = ascii_lowercase + "".join(chr(c) for c in range(ord("ß"), 256) if chr(c).isalpha())
_SIMPLE = re.compile(rf"[{_LETTERS}!-&(-/:-@\[-`{{-~]+")
_PIECES = re.compile(rf"[{_LETTERS}]+|[^{_LETTERS}]+")
_SIGNS = punctuation.replace("'", "").encode()


class _Pieces(dict):
    """Token ids of pieces of plain letters, or of signs, made where one is first asked for."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        cut = self._tokenizer.pre_tokenizer
        self._letters = {ord(c): cut.pre_tokenize_str(c)[0][0] for c in _LOWER} if cut else {}
        self._direct = self._encoded(_LOWER) == self._by_model(_LOWER)

    def _encoded(self, piece: str) -> bytes:
        return np.array(self._tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_model(self, piece: str) -> bytes:
        return array("I", [token.id for token in self._model.tokenize(piece if piece.isascii() else piece.translate(self._letters))]).tobytes()

    def whole(self, word: str) -> bytes:
        """The ids of a word that is not of plain letters and signs."""
        made = self[word] = self._encoded(word)
        return made

    def __missing__(self, piece: str) -> bytes:
        made = self[piece] = self._by_model(piece) if self._direct and piece.isalpha() else self._encoded(piece)
        return made


class WordIds:
    """Token ids of a text as bytes of 32-bit little-endian numbers, by remembered words and pieces of words.

    Right for tokenizers whose tokens never cross ASCII white space, and drop it: then the ids of a
    text are those of its words, one after the other. This one also ignores case and parts letters from
    other signs, so words of plain letters and signs are put together from their pieces, of which there are
    fewer. Digits, apostrophes, special tokens and everything beyond Latin-1 letters go to the tokenizer whole.

    Pieces of letters go to the tokenizer's model itself, which takes less time, if the tokenizer hands it the text of
    all letters whole, each as it is written alone.
    """

    def __init__(self, path: str, most: int = REMEMBERED) -> None:
        self._most = most
        self._words: dict[bytes, bytes] = {}
        self._pieces = _Pieces(path)

    def learn(self, texts: list[list[bytes]]) -> None:
        """Remember the words of the texts, of which there should be some MB at most: what is remembered is bounded before that."""
        words, pieces = self._words, self._pieces
        used = set().union(*texts)
        new = used.difference(words)
        if len(words) > self._most:
            _forget(words, self._most * 3 // 4, used - new)
        if len(pieces) > self._most:
            _forget(pieces, self._most * 3 // 4)
        for word in new:
            if word.isalpha():  # ASCII letters alone: one piece
                words[word] = pieces[word.lower().decode()]
                continue
            core = word.rstrip(_SIGNS)
            if core.isalpha() and b"<|" not in word:
                words[word] = pieces[core.lower().decode()] + pieces[word[len(core) :].decode()]
                continue
            shown = word.decode()
            if _SIMPLE.fullmatch(shown) and "<|" not in shown:
                own = _PIECES.findall(shown.lower())
                words[word] = pieces[own[0]] if len(own) == 1 else b"".join([pieces[p] for p in own])
            else:
                words[word] = pieces.get(shown) or pieces.whole(shown)

    def ids(self, text: bytes) -> bytes:
        return self.ids_of(text.split())

    def ids_of(self, words: list[bytes]) -> bytes:
        try:
            return b"".join(map(self._words.__getitem__, words))
        except KeyError:
            self.learn([words])
            return b"".join(map(self._words.__getitem__, words))


def _forget(known: dict, left: int, used: Collection = ()) -> None:
    """Forget what was learned first until ``left`` are left, but nothing of ``used``."""
    for key in used:
        known[key] = known.pop(key)
    for key in list(islice(known, max(0, len(known) - max(left, len(used))))):
        del known[key]


class Remembered:
    """The tokenizer of a worker process, made where it is first asked for.

    A broadcast holds it: tasks of one call that follow each other in a worker share what it remembers, and Spark
    takes it from the worker before a task of other work runs there, which then has that memory.
    """

    def __init__(self, path: str, most: int) -> None:
        self._path, self._most = path, most

    @cached_property
    def words(self) -> WordIds:
        return WordIds(self._path, self._most)


class Packer:
    """At most ``n_open`` open windows; a piece goes where it leaves least room.

    If it fits nowhere it is cut: it fills up the fullest window, which is then emitted, so that
    emitted windows have no padding. ``done`` holds (window, pieces) of emitted windows; a piece is
    (document, ids, first id).
    """

    def __init__(self, length: int, n_open: int) -> None:
        self.length, self.n_open = length, n_open
        self.open: list[tuple[int, list]] = []  # room left, pieces
        self.done: list[list] = []

    def put(self, doc: tuple, ids: np.ndarray, start: int = 0) -> None:
        while len(ids):
            if len(ids) >= self.length:
                self.done.append([(doc, ids[: self.length], start)])
                ids, start = ids[self.length :], start + self.length
                continue
            fits = [i for i, (room, _) in enumerate(self.open) if room >= len(ids)]
            if fits:
                at = min(fits, key=lambda i: self.open[i][0])
            elif len(self.open) < self.n_open:
                self.open.append((self.length, []))
                at = len(self.open) - 1
            else:
                at = min(range(len(self.open)), key=lambda i: self.open[i][0])
            room, pieces = self.open[at]
            take = min(room, len(ids))
            pieces.append((doc, ids[:take], start))
            ids, start = ids[take:], start + take
            if take == room:
                self.done.append(pieces)
                del self.open[at]
            else:
                self.open[at] = (room - take, pieces)


def _rows(windows: list[list], first: int) -> Iterator[tuple]:
    for number, pieces in enumerate(windows, first):
        offset = 0
        for (doc, total), ids, start in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset
            offset += len(ids)


def _cut_to_powers(window: list) -> list[list]:
    """A window cut into windows whose lengths are powers of two, longest first: none needs padding."""
    left, out = sum(len(ids) for _, ids, _ in window), []
    pieces = list(window)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            doc, ids, start = pieces.pop(0)
            part.append((doc, ids[:size], start))
            if len(ids) > size:
                pieces.insert(0, (doc, ids[size:], start + size))
            size -= len(part[-1][1])
        out.append(part)
    return out


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, n_open: int = OPEN_WINDOWS,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a document: its place in the document and in its sequence.

    ``tokenizer`` is a file every executor has. A document is its token ids and then ``END_ID``. Each
    partition of the scan packs its documents in their order with ``n_open`` open windows; what is open
    at its end (at most ``n_open * length`` ids) is written with its ids, and the leftovers of
    ``MERGED_PARTITIONS`` partitions are packed again in one bounded task. What then remains is cut into
    windows whose lengths are powers of two, so no sequence is padded.

    The first pass is written once; a task that is run again reads the same split and makes the same
    windows. A null or empty text has the end id alone. Repeated rows are packed once each. A null
    id stays null. An empty table gives no rows. Extra columns are not read.

    ``remembered`` words, and as many pieces of words, are held by each worker process: fewer take less memory and more
    time, and give the same rows.
    """
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("part", pa.int64()), ("ids", pa.binary())]
    )
    held_words = docs.sparkSession.sparkContext.broadcast(Remembered(tokenizer, remembered))

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        words, packer, number = held_words.value.words, Packer(length, n_open), part << 32
        end = np.array([END_ID], "<u4").tobytes()
        for batch in in_parts(batches, most=PART_BYTES):
            texts = [body.split() for body in batch.column("body").to_pylist()]
            words.learn(texts)
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids = np.frombuffer(words.ids_of(text) + end, "<u4")
                packer.put((doc, len(ids)), ids)
            yield as_batch([(*row, None, None) for row in _rows(packer.done, number)], schema)
            number += len(packer.done)
            packer.done = []
            del batch, texts, text, ids  # before the next ones are made
        held = [[(doc, ids, start) for doc, ids, start in pieces] for _, pieces in packer.open]
        rows = zip(_rows(held, number), (ids.tobytes() for pieces in held for _, ids, _ in pieces))
        yield as_batch([(*row, part, ids) for row, ids in rows], schema)

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))
    first = materialize(texts.mapInArrow(pack_partition, _PIECE + ", part long, ids binary"), "packed")

    def merge(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(length, n_open)
        held = held.sort_values(["sequence_id", "offset"])
        for doc, total, start, ids in zip(held["doc_id"], held["doc_tokens"], held["start"], held["ids"]):
            packer.put((None if pd.isna(doc) else int(doc), int(total)), np.frombuffer(ids, "<u4"), int(start))
        last = [part for _, pieces in packer.open for part in _cut_to_powers(pieces)]
        made = pd.DataFrame(_rows(packer.done + last, ((1 << 30) + int(key[0])) << 32), columns=[c.split()[0] for c in _PIECE.split(", ")])
        return made.astype({"doc_id": "Int64"})

    full = first.filter(F.col("part").isNull()).drop("part", "ids")
    group = F.floor(F.col("part") / MERGED_PARTITIONS).alias("group")
    return full.unionByName(first.filter(F.col("part").isNotNull()).groupBy(group).applyInPandas(merge, _PIECE))
