"""BPE encoding as a streaming transducer with bounded look-ahead, and incremental decoding.

A merge can be undone by later text only through a chain of merges: each one reaches over the
place where two readings still differ, joins the token before it, and so moves that place to the
left by the token's length. Along a chain the merges get later in the list, and each one's right
part begins with the token that the one before had as its left part. The longest such chain is the
merge list's look-ahead: tokens that end so far before the end of what has been read are final.

A piece of text longer than the look-ahead is therefore encoded in a buffer of constant size;
final tokens leave it at once. Units of text between white space repeat a lot, so a task keeps the
ids of up to `CACHED` of them.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, columns_of, record_batch, shipped, unpacked

CACHED = 400_000
STEP = 64  # symbols read beyond the look-ahead before tokens are emitted
UNITS = 50_000  # units of a text handled at once

# Unicode's White_Space characters.
WHITE = "\t-\r \x85\xa0  -     　"
_WHITE_RUN = re.compile(f"[{WHITE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split() only

_DIGESTS = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Vocabulary and ranked merges of a tokenizer file, with their sufficient look-ahead."""

    def __init__(self, model: dict) -> None:
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.lookahead = self._lookahead(pairs)

    def _lookahead(self, pairs: list[tuple[str, str]]) -> int | None:
        """Symbols before the end of the input that more input can still change; None: unknown."""
        size: dict[str, int] = {}
        starts: dict[str, tuple[str, ...]] = {}  # tokens that begin a token's derivation, itself first
        reach: dict[str, int] = {}  # longest chain so far that ends with this left part
        longest = 0
        for left, right in pairs:
            for part in (left, right):
                if part not in size:
                    if len(part.removesuffix(self.suffix) if self.suffix else part) != 1:
                        return None  # a part that no earlier merge makes
                    size[part], starts[part] = 1, (part,)
            whole = left + right
            if whole not in size:
                size[whole], starts[whole] = size[left] + size[right], (whole, *starts[left])
            else:
                starts[whole] = tuple(dict.fromkeys((*starts[whole], *starts[left])))
            chain = size[left] + max(reach.get(t, 0) for t in starts[right])
            reach[left] = max(reach.get(left, 0), chain)
            longest = max(longest, chain)
        return longest

    def merge(self, parts: list[str]) -> list[str]:
        """All merges of a list of symbols: of the pairs with the lowest rank, the leftmost first."""
        rank, none = self.ranks.get, len(self.ranks)
        ranks = list(map(rank, zip(parts, parts[1:]), repeat(none)))
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            token = parts[at] + parts[at + 1]
            parts[at : at + 2] = [token]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((token, parts[at + 1]), none)
            if at:
                ranks[at - 1] = rank((parts[at - 1], token), none)
        return parts

    def encode(self, piece: str) -> Iterable[str]:
        """Tokens of one piece of byte letters."""
        if self.lookahead is None or len(piece) <= self.lookahead + STEP:
            return self.merge([*piece[:-1], piece[-1] + self.suffix])
        return self.transduce(piece)

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one long piece, each emitted once nothing that follows can change it."""
        held: list[str] = []
        for symbol in symbols:
            held.append(symbol)
            # the newest symbol may be the piece's last, which is another symbol, so it stays out
            if len(held) > self.lookahead + STEP:
                final, done = len(held) - 1 - self.lookahead, 0
                for token in self.merge(held[:-1]):
                    if done + len(token) > final:
                        break
                    done += len(token)
                    yield token
                held = held[done:]
        if held:
            held[-1] += self.suffix
            yield from self.merge(held)


class Tokenizer:
    """Encoder and decoder for a tokenizer file with byte-level BPE."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        self.merges = Merges(spec["model"])
        self.letters = byte_letters()
        self.tokens = {i: t for t, i in self.merges.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split_special = re.compile(f"({'|'.join(names)})") if names else None
        self.spaced = spec["decoder"] is None  # then decoding puts a blank between tokens
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", WHITE))
        self.pieces: dict[str, list[int]] = {}
        self.encoded: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    @staticmethod
    def normalise(text: str) -> str:
        """NFC, then lower case character by character, without regard to a word's end."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def units(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Special tokens (True) and runs of text between white space (False), in order."""
        parts = [text] if self.split_special is None else self.split_special.split(text)
        for number, part in enumerate(parts):
            if number % 2:
                yield True, [part]
            elif part:
                part = self.normalise(part)
                if _SEPARATORS.search(part):
                    yield False, [u for u in _WHITE_RUN.split(part) if u]
                else:
                    yield False, part.split()

    def encode_unit(self, unit: str) -> list[int]:
        pieces = [unit] if unit.isascii() and unit.isalpha() else self.pattern.findall(unit)
        ids: list[int] = []
        for piece in pieces:
            if (known := self.pieces.get(piece)) is None:
                letters = "".join(map(self.letters.__getitem__, piece.encode()))
                known = [self.merges.ids[token] for token in self.merges.encode(letters)]
                if len(self.pieces) < CACHED:
                    self.pieces[piece] = known
            ids += known
        return ids

    def encode_stream(self, text: str) -> Iterator[tuple[bytes, str]]:
        """The text's ids, packed as unsigned 32-bit integers, and what they decode to, in pieces."""
        for special, units in self.units(text):
            if special:
                ids = self.special[units[0]]
                yield struct.pack("<I", ids), self.decode([ids])
                continue
            for at in range(0, len(units), UNITS):
                some = units[at : at + UNITS]
                new = {u for u in some if u not in self.encoded}
                if len(self.encoded) + len(new) > CACHED:
                    self.encoded.clear()
                    self.decoded.clear()
                    self.pieces.clear()
                    new = set(some)
                for unit in new:
                    ids = self.encode_unit(unit)
                    self.encoded[unit] = struct.pack(f"<{len(ids)}I", *ids)
                    self.decoded[unit] = self.decode(ids)
                between = " " if self.spaced else ""
                yield b"".join(map(self.encoded.__getitem__, some)), between.join(
                    map(self.decoded.__getitem__, some))

    def encode(self, text: str) -> list[int]:
        packed = b"".join(ids for ids, _ in self.encode_stream(text))
        return list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def decode(self, ids: Iterable[int]) -> str:
        """Token strings with blanks between them if the file names no decoder, else the text."""
        if self.spaced:
            return " ".join(map(self.tokens.__getitem__, ids))
        return "".join(self.text_stream(ids))

    def text_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of each token in turn: bytes that end inside a character wait for the next token."""
        back = {letter: b for b, letter in enumerate(self.letters)}
        state = codecs.getincrementaldecoder("utf-8")(errors="replace")
        special, suffix = set(self.special.values()), self.merges.suffix
        for i in ids:
            token = self.tokens[i]
            if i in special:
                yield state.decode(b"", final=True) + token
                state.reset()
                continue
            ends = bool(suffix) and token.endswith(suffix)
            letters = token.removesuffix(suffix) if ends else token
            yield state.decode(bytes(back[c] for c in letters)) + (" " if ends else "")
        yield state.decode(b"", final=True)


def _digester(shared):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = unpacked(shared)  # stays with the worker, and so do the units it has seen
        for batch in batches:
            ids, texts = columns_of(batch, "doc_id", "text")
            counts, of_ids, of_text = [], [], []
            for raw in texts:
                packed, text = hashlib.sha256(), hashlib.sha256()
                count, first = 0, True
                for some, decoded in tokenizer.encode_stream((raw or b"").decode("utf-8", "replace")):
                    packed.update(some)
                    count += len(some) // 4
                    if decoded:
                        text.update(decoded.encode() if first or not tokenizer.spaced else b" " + decoded.encode())
                        first = False
                counts.append(count)
                of_ids.append(packed.hexdigest())
                of_text.append(text.hexdigest())
            yield record_batch(_DIGESTS, ids, counts, of_ids, of_text)

    return digest


def _encoder(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = unpacked(shared)
        for batch in batches:
            ids, texts = columns_of(batch, "doc_id", "text")
            found = [tokenizer.encode((t or b"").decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "ids": pa.array(found, pa.list_(pa.int32()))})

    return encode


def _decoder(shared):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = unpacked(shared)
        for batch in batches:
            ids, found = columns_of(batch, "doc_id", "ids")
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "text": pa.array([tokenizer.decode(x or []) for x in found])})

    return decode


def _rows(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _shared(df: DataFrame, path: str):
    """The tokenizer of a file that the driver can read: a few MB, whatever the corpus."""
    with open(path, encoding="utf-8") as file:
        return shipped(df.sparkSession, Tokenizer(file.read()))


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids) for each row; a null or empty text has no ids."""
    return _rows(docs).mapInArrow(_encoder(_shared(docs, tokenizer_path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) for each row of (doc_id, ids); null or no ids give an empty text."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoder(_shared(encoded, tokenizer_path)), "doc_id long, text string")


def encode_and_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of `docs`.

    Ids and decoded text are digested as they are emitted, never held for a whole text. A null or
    empty text has no tokens. Rows with null or repeated ids are encoded by themselves. Columns
    besides `doc_id` and `text` are not read.
    """
    return _rows(docs).mapInArrow(
        _digester(_shared(docs, tokenizer_path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
