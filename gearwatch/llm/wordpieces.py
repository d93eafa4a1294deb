"""BPE encoding and decoding with a contiguous array of ranks per word.

A word is its symbols in a row. One list holds where parts begin, another the rank of merging each
part with the next. The least rank is found by scanning, its boundary deleted, and the two ranks
beside it refreshed. Words are short, so scans are, and words recur, so results are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words remembered per Python worker (about 400 bytes each).
REMEMBERED = 300_000
NEVER = sys.maxsize
#: Symbols of a word from which ranks wait in a heap instead of being scanned; the result is the same.
LONG = 256


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 stands for itself; the other bytes, in order, for characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, spare = [""] * 256, 256
    for b in own:
        shown[b] = chr(b)
    for b in range(256):
        if not shown[b]:
            shown[b], spare = chr(spare), spare + 1
    return shown


ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def character_class(pattern: str) -> str:
    """Characters below 0x10000 that match ``pattern``, as the inside of a class of the re module."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    runs = (m.group() for m in regex.finditer(f"{pattern}+", every))
    return "".join(re.escape(r[0]) + (f"-{re.escape(r[-1])}" if len(r) > 1 else "") for r in runs)


def plain_patterns(pattern: str) -> tuple[str, str]:
    """A pattern with letter, number and space classes (inside brackets) twice.

    For texts of characters below 0x10000 in the faster re module, and for any text in regex.
    """
    classes = ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{White_Space}"))
    narrow = wide = pattern
    for name, of in classes:
        narrow, wide = narrow.replace(name, character_class(of)), wide.replace(name, of)
    return narrow, wide


def piece_finder(patterns: tuple[str, str]) -> Callable[[str], list[str]]:
    narrow, wide = re.compile(patterns[0]).findall, regex.compile(patterns[1]).findall
    return lambda text: wide(text) if ASTRAL.search(text) else narrow(text)


def split_added(added: list[str]) -> Callable[[str], list[str]]:
    """Cuts a text at added tokens; odd places of the result hold the tokens themselves."""
    if not added:
        return lambda text: [text]
    found = re.compile("(" + "|".join(re.escape(a) for a in sorted(added, key=len, reverse=True)) + ")")
    return found.split


class Remembered(dict):
    """Results of a function by its argument."""

    def __init__(self, function: Callable):
        self.function = function

    def __missing__(self, key):
        made = self[key] = self.function(key)
        return made


def definition_of(path: str) -> dict:
    """What a tokenizer file says, its pattern made plain."""
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    return {
        "end": read["model"]["end_of_word_suffix"] or "",
        "vocab": read["model"]["vocab"],
        "merges": [tuple(m if isinstance(m, list) else m.split(" ")) for m in read["model"]["merges"]],
        "added": {a["content"]: a["id"] for a in read["added_tokens"]},
        "patterns": plain_patterns(read["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]),
    }


class WordBpe:
    """A tokenizer file of kind word-end BPE: NFC, spaces folded, lower case, then merges."""

    def __init__(self, definition: dict):
        self.end, self.ids, self.added = definition["end"], definition["vocab"], definition["added"]
        self.ranks = {m: i for i, m in enumerate(definition["merges"])}
        names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i) for i in range(max(names, default=-1) + 1)]
        self.cut = split_added(list(self.added))
        self.shown = dict(enumerate(byte_symbols()))
        self.pieces = piece_finder(definition["patterns"])
        self.words = Remembered(self._word)

    def parts(self, piece: str) -> list[str]:
        """Vocabulary symbols of one word."""
        word = piece.encode().decode("latin-1").translate(self.shown) + self.end
        last = len(word) - len(self.end)
        if last > LONG:
            return self._long_parts(word, last)
        begins = [*range(last), len(word)]  # the last symbol carries the word end
        rank = self.ranks.get
        costs = [rank((word[i], word[i + 1 : i + 2]), NEVER) for i in range(last - 2)]
        if last > 1:
            costs.append(rank((word[last - 2], word[last - 1 :]), NEVER))
        while costs:
            least = min(costs)
            if least == NEVER:
                break
            i = costs.index(least)
            del begins[i + 1], costs[i]
            a, b = begins[i], begins[i + 1]
            if i < len(costs):
                costs[i] = rank((word[a:b], word[b : begins[i + 2]]), NEVER)
            if i:
                costs[i - 1] = rank((word[begins[i - 1] : a], word[a:b]), NEVER)
        return [word[a:b] for a, b in zip(begins, begins[1:])]

    def _long_parts(self, word: str, last: int) -> list[str]:
        """The same for a long word: ranks wait in a heap and boundaries are linked, so no array is scanned."""
        rank = self.ranks.get
        begin = [*range(last), len(word)]
        after, before = [*range(1, last), last, -1], [-1, *range(last)]
        cost = [NEVER] * (last + 1)
        heap: list[tuple[float, int]] = []

        def look(i: int) -> None:
            """Rank of the symbol at boundary i with the next one."""
            j = after[i]
            k = after[j] if j != last else -1
            found = rank((word[begin[i] : begin[j]], word[begin[j] : begin[k]]), NEVER) if k >= 0 else NEVER
            cost[i] = found
            if found != NEVER:
                heapq.heappush(heap, (found, i))

        for i in range(last):
            look(i)
        while heap:
            least, i = heapq.heappop(heap)
            if cost[i] != least:
                continue  # refreshed or gone since
            j = after[i]
            cost[j] = NEVER
            after[i] = after[j]
            before[after[j]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        out, i = [], 0
        while i != last:
            out.append(word[begin[i] : begin[after[i]]])
            i = after[i]
        return out

    def _word(self, piece: str) -> bytes:
        """Ids of a word as little-endian unsigned 32-bit integers.

        A symbol the vocabulary lacks is left out, as where no unknown token is defined.
        """
        return b"".join(self.ids[p].to_bytes(4, "little") for p in self.parts(piece) if p in self.ids)

    def normal(self, text: str) -> str:
        # Character by character: a sigma at the end of a word is no special case.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as bytes, text decoded from them) of a whole text."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
        found: list[bytes] = []
        for i, segment in enumerate(self.cut(text)):
            if i % 2:
                found.append(self.added[segment].to_bytes(4, "little"))
            else:
                found += map(self.words.__getitem__, self.pieces(self.normal(segment)))
        ids = b"".join(found)
        return ids, self.decode(ids)

    def decode(self, ids: bytes) -> str:
        """Names of the ids joined by one space, which is what a file without a decoder asks for."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encoded(docs: DataFrame, definition: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), digest: bool = True) -> DataFrame:
    """(id, n_tokens, ids, decoded, *keep) per row of ``docs``.

    With ``digest``, ``ids`` and ``decoded`` are lowercase hex SHA-256 of the little-endian
    unsigned 32-bit ids and of the decoded UTF-8 text; otherwise an array of ids and the text.
    ``decoded`` is decoded from the ids. Null text is empty: no tokens, empty decoded text.
    Texts are encoded whole. Repeated rows each get a row, other columns are ignored.
    ``definition`` comes from ``definition_of`` on the driver and is broadcast (a few MB).
    """
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = WordBpe(shipped.value)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.pop("_text"):
                own, shown = bpe.encode(text)
                counts.append(len(own) // 4)
                ids.append(hashlib.sha256(own).hexdigest() if digest else np.frombuffer(own, dtype="<u4").astype("int32"))
                texts.append(hashlib.sha256(shown.encode()).hexdigest() if digest else shown)
            yield batch.assign(n_tokens=np.array(counts, dtype="int64"), ids=ids, decoded=texts)

    picked = docs.select(F.col(id_col), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema if f.name != "_text")
    out = picked.mapInPandas(run, f"{fields}, n_tokens long, ids {'string' if digest else 'array<int>'}, decoded string")
    return out.select(id_col, "n_tokens", "ids", "decoded", *keep)
