"""Encoding with a given merge list in constant memory, and decoding byte by byte.

A merge only reaches as far to the left as a chain of rules can carry it. ``MergeList`` computes the longest such chain,
the list's sufficient lookahead: tokens that end further than that from the end of what was read cannot change any more.
``Transducer`` emits them and forgets their bytes, so that a word of any length needs a window of fixed size.
``Decoder`` turns ids back into text, holding no more than the bytes of one unfinished character.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from folioscope.llm.common import arrow_schema, columns, ready

# characters of a text worked on at once, symbols added to a window at once, longest word and number of words remembered
PIECE = 1 << 16
WINDOW = 512
MEMO_CHARS = 48
MEMO_WORDS = 150_000
NEVER = 1 << 60


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class MergeList:
    """Ranked merges of symbol ids, with the lookahead after which a token is final.

    Needs what lists of byte-pair encoders have: every symbol is made by one rule at most, and from symbols of earlier
    rules. Both are checked, a list without these properties is refused.
    """

    def __init__(self, merges: list[tuple[str, str]], ids: dict[str, int], suffix: str = ""):
        self.rank: dict[tuple[int, int], int] = {}
        self.product: list[int] = []
        made: set[str] = set()
        for rank, (left, right) in enumerate(merges):
            whole = left + right
            if whole in made:
                raise ValueError(f"two rules make {whole!r}")
            made.add(whole)
            self.rank[ids[left], ids[right]] = rank
            self.product.append(ids[whole])
        seen: set[str] = set()
        for left, right in merges:
            if any(side in made and side not in seen for side in (left, right)):
                raise ValueError(f"a rule uses {left!r} or {right!r} before it is made")
            seen.add(left + right)
        self.lookahead = self._lookahead(merges, suffix)

    @staticmethod
    def _lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
        """Greatest distance over which what follows can change a boundary, in symbols.

        Compare a run on the text with a run on the text and what follows it, and follow the leftmost boundary at which they
        differ. The first one lies at most one right operand before the end of the text. The next rule that moves it
        to the left applies at the start of the left operand ``u`` of the last one, at a later rank, and its right operand is
        ``u`` or begins with ``u``. So the distance is that of the longest chain of such rules, found in rank order.
        """

        def size(symbol: str) -> int:
            return len(symbol.removesuffix(suffix)) if suffix else len(symbol)

        # longest chain that ends in a rule with this left operand, or with one that this symbol begins with
        ends: dict[str, int] = {}
        begins: dict[str, int] = {}
        longest = 0
        for left, right in merges:
            reach = max(size(right), ends.get(right, 0), begins.get(right, 0))
            ends[left] = max(ends.get(left, 0), reach + size(left))
            begins[left + right] = max(ends[left], begins.get(left, 0))
            longest = max(longest, reach)
        return longest

    def merge(self, symbols: list[int]) -> list[int]:
        """``symbols`` with all merges applied, the least rank first, of equal ranks the leftmost."""
        rank, product = self.rank, self.product
        ranks = [rank.get(pair, NEVER) for pair in zip(symbols, symbols[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            at = ranks.index(least)
            symbols[at : at + 2] = [product[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get((symbols[at - 1], symbols[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank.get((symbols[at], symbols[at + 1]), NEVER)
        return symbols


class Transducer:
    """Bytes of one word in, final tokens out; holds ``lookahead`` + two blocks of symbols and a token at most."""

    def __init__(self, coder: Coder, block: int = WINDOW):
        self.coder, self.block = coder, block
        self.window: list[int] = []

    def feed(self, data: bytes) -> Iterator[int]:
        merges, sizes = self.coder.merges, self.coder.sizes
        for start in range(0, len(data), self.block):
            self.window += [self.coder.inner[b] for b in data[start : start + self.block]]
            # merged once a block is full, however the bytes come in
            if len(self.window) <= merges.lookahead + self.block:
                continue
            final, end = len(self.window) - merges.lookahead - 1, 0
            for token in merges.merge(self.window[:]):
                if end + sizes[token] > final:
                    break
                end += sizes[token]
                yield token
            del self.window[:end]

    def end(self) -> Iterator[int]:
        """The rest of the word, now that its last byte is known to be the last."""
        if self.window:
            self.window[-1] = self.coder.last[self.coder.byte_of[self.window[-1]]]
            yield from self.coder.merges.merge(self.window)
        self.window = []


class Memo(dict):
    """Token ids of short words; forgets all when it is full."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> tuple[int, ...]:
        tokens = self.coder.word(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


class Characters:
    """Letters, numbers, white space and lower case as the tokenizers library has them.

    The library, ``regex`` and Python follow different versions of Unicode. Where a text has characters on which they
    differ (``odd``), patterns with the library's classes spelled out are used; others have a fast pattern.
    """

    NAMES = {r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}", r"\s": r"\p{White_Space}"}

    def __init__(self):
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        odd: set[str] = set()
        self.ranges = {}
        for theirs, ours in self.NAMES.items():
            found = pre_tokenizers.Split(Regex(theirs), "removed", invert=True).pre_tokenize_str(every)
            members = "".join(w for w, _ in found)
            odd |= set(members) ^ set(regex.findall(ours, every))
            self.ranges[theirs] = _ranges(members)
        # one character a line; the line feed itself has no case
        lines = normalizers.Lowercase().normalize_str("\n".join(every.replace("\n", ""))).split("\n")
        lower = {c: low for c, low in zip(every.replace("\n", ""), lines) if low != c.replace("Σ", "σ").lower()}
        self.lower = str.maketrans(lower)
        self.odd = re.compile(f"[{_ranges(odd | lower.keys())}]")

    def compiled(self, pattern: str, spelled_out: bool) -> re.Pattern:
        for theirs, ours in self.NAMES.items():
            pattern = pattern.replace(f"[{theirs}]", theirs) if not spelled_out else pattern
            pattern = pattern.replace(theirs, self.ranges[theirs] if spelled_out else ours)
        return re.compile(pattern) if spelled_out else regex.compile(pattern)


def _ranges(members: Iterable[str]) -> str:
    """The characters as ranges of a pattern's class."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, members)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


@lru_cache(maxsize=1)
def characters() -> Characters:
    return Characters()


class Coder:
    """A tokenizer file of this kind: NFC, white space, lower case; words by a pattern; byte alphabet; merges."""

    def __init__(self, spec: dict):
        model, alphabet = spec["model"], byte_alphabet()
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split, bytelevel = spec["pre_tokenizer"]["pretokenizers"]
        own = (steps, split["type"], split["invert"], split["behavior"], bytelevel["type"], bytelevel["add_prefix_space"], model["type"])
        if own != (["NFC", "Replace", "Lowercase"], "Split", True, "Removed", "ByteLevel", False, "BPE"):
            raise ValueError("not a lower-case word tokenizer with byte-level merges")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = MergeList(rules, self.ids, self.suffix)
        self.inner = [self.ids[c] for c in alphabet]
        self.last = [self.ids[c + self.suffix] for c in alphabet]
        self.byte_of = {symbol: b for b, symbol in enumerate(self.inner)}
        self.sizes = {i: len(t.removesuffix(self.suffix) if self.suffix else t) for t, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.characters = characters()
        self.patterns = [self.characters.compiled(split["pattern"]["Regex"], own) for own in (False, True)]
        self.runs = self.characters.compiled(r"[\p{L}]+|[^\s\p{L}\p{N}]+", True)
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.memo = Memo(self)
        self.decoder = spec["decoder"]

    def word(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        if len(data) > MEMO_CHARS * 4:
            machine = Transducer(self)
            return (*machine.feed(data), *machine.end())
        return tuple(self.merges.merge([*(self.inner[b] for b in data[:-1]), self.last[data[-1]]]))

    def normal(self, piece: str) -> tuple[str, bool]:
        """NFC and lower case of single characters (sigma has one, wherever it stands), and whether odd ones occur."""
        piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        odd = not piece.isascii() and bool(self.characters.odd.search(piece))
        return (piece.translate(self.characters.lower) if odd else piece).lower(), odd

    def cut(self, text: str, start: int, size: int) -> int:
        """Where the piece that starts at ``start`` ends: before white space, else where nothing spans the cut but a run."""
        end = start + size
        if end >= len(text):
            return len(text)
        blank = max(text.rfind(" ", start + 1, end), text.rfind("\n", start + 1, end))
        if blank > start:
            return blank
        while end < len(text) and not self._free(text, end):
            end += 1
        return end

    def _free(self, text: str, at: int) -> bool:
        return (
            not _joins(text[at])
            and ("'" not in text[max(at - 3, 0) : at] or text[max(at - 2, 0) : at] == "''")
            and not any(text.startswith(t, at - k) for t in self.added for k in range(1, min(len(t), at + 1)))
        )

    def encode(self, text: str, size: int = PIECE) -> Iterator[Iterable[int]]:
        """Token ids of a whole text, piece by piece."""
        start = 0
        machine, run = Transducer(self), False
        while start < len(text):
            end = self.cut(text, start, size)
            at = start
            for special in self.specials.finditer(text, start, end):
                yield from self._piece(text[at : special.start()], machine, run, False)
                run = False
                yield (self.added[special.group()],)
                at = special.end()
            open_end = end < len(text) and not self.specials.match(text, end)
            run = yield from self._piece(text[at:end], machine, run, open_end)
            start = end
        yield machine.end()

    def _piece(self, piece: str, machine: Transducer, run: bool, open_end: bool) -> Iterator[Iterable[int]]:
        """Tokens of a piece. ``run`` says that ``machine`` holds a word that this piece may continue; the result says
        whether it holds one after it."""
        piece, odd = self.normal(piece)
        at = 0
        if run:
            more = self.runs.match(piece) if piece else None
            if more and self._same_run(more.group(), self.kind):
                at = more.end()
                yield machine.feed(more.group().encode())
                if at == len(piece) and open_end:
                    return True
            yield machine.end()
        words = self.patterns[odd].findall(piece, at)
        tail = None
        if open_end and words and piece.endswith(words[-1]) and self.runs.fullmatch(words[-1]):
            tail = words.pop()
        yield chain.from_iterable(map(self.memo.__getitem__, words))
        if tail is None:
            return False
        self.kind = tail
        yield machine.feed(tail.encode())
        return True

    def _same_run(self, more: str, held: str) -> bool:
        return bool(self.runs.fullmatch(held[-1] + more[0]))


def _joins(char: str) -> bool:
    """True for characters that normalisation can reorder or join with what stands before them."""
    return unicodedata.combining(char) > 0 or char in _seconds()


@lru_cache(maxsize=1)
def _seconds() -> frozenset[str]:
    """Second characters of canonical pairs, and the Hangul vowels and finals."""
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    pairs = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(pairs | set(map(chr, range(0x1161, 0x1176))) | set(map(chr, range(0x11A8, 0x11C3))))


class Decoder:
    """Ids in, text out: the bytes of tokens run through a UTF-8 machine that keeps only an unfinished character.

    Without a decoder in the file the token strings themselves are the text, with a blank between two; with a byte-level
    one their bytes are. Unknown ids give nothing; broken bytes become U+FFFD.
    """

    def __init__(self, coder: Coder):
        kind = coder.decoder and coder.decoder["type"]
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"unknown decoder {kind}")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.between = b"" if kind else b" "
        self.bytes_of = {
            i: bytes(byte_of[c] for c in t) if kind and all(c in byte_of for c in t) else t.encode() for t, i in chain(coder.ids.items(), coder.added.items())
        }
        self.reset()

    def reset(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def feed(self, ids: Iterable[int]) -> str:
        known = [self.bytes_of[i] for i in ids if i in self.bytes_of]
        if not known:
            return ""
        lead = b"" if self.first else self.between
        self.first = False
        return self.machine.decode(lead + self.between.join(known))

    def end(self) -> str:
        rest = self.machine.decode(b"", True)
        self.reset()
        return rest


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """The tokenizer at ``path``, loaded once per worker."""
    return Coder(json.loads(Path(path).read_text(encoding="utf-8")))


def round_trip(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, decoded``: the token ids of every whole text and the text that they decode to.

    Strings of special tokens inside a text are those tokens, none is added. Null and empty texts have no ids and decode
    to the empty text; null keys stay null, repeated rows give repeated rows, no rows give no rows; other columns are
    not read. The table is only scanned. Beside the ids of one text, the memory of a task is that of a piece of text, a
    window of bytes and a bounded memo of words.
    """
    spark = docs.sparkSession
    ready(spark)
    given = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {given.schema['key'].dataType.simpleString()}, ids array<int>, decoded string"
    wanted = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = coder(tokenizer_path)
        decoder = Decoder(machine)
        for batch in batches:
            ids, ends, decoded = [], [0], []
            for value in batch.column(1).to_pylist():
                own = [np.fromiter(part, dtype=np.int32) for part in machine.encode(value or "")]
                decoded.append("".join([*(decoder.feed(part.tolist()) for part in own), decoder.end()]))
                ids += own
                ends.append(ends[-1] + sum(map(len, own)))
            if decoded:
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)
                yield columns([batch.column(0), lists, decoded], wanted)

    return given.mapInArrow(run, schema).withColumnRenamed("key", key)
