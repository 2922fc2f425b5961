"""BPE encoding and decoding as streams with bounded memory.

Encoding. Within one pre-token, bytes that arrive later can change the tokens of what came
before only so far back. A merge (u, v) takes part in such a change if v starts where the
change has reached so far, and it carries the change back by the length of u. The next merge
of the chain has a higher rank and a right part that starts with u: u is on the left edge of
its derivation. The longest such chain over the merge list is the sufficient lookahead, in
bytes (320 for the installed 50k vocabulary). Tokens that end further than this before the
end of the input are stable and are emitted; what follows them is kept. A token boundary that
holds for the whole input also holds for the part behind it, so the kept bytes can be merged
on their own later.

The split into pre-tokens streams too: a match is settled once a character behind it has been
seen. An open run of one kind of character that outgrows a window goes into the merge stage
piece by piece, so not even a text without blanks needs more than the window.

Decoding. Ids become bytes, bytes go through an incremental UTF-8 state machine that holds at
most three bytes of an unfinished character.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.pretokens import patterns, sufficient_lookahead, vocabulary
from tidemark.llm.texts import map_texts
from tidemark.llm.token_counts import Ranks

CHUNK = 1 << 16  # characters taken from a text at a time
WINDOW = 1024  # characters of an open run that are held before it is passed on
REMEMBERED = 200_000  # pre-tokens whose tokens a worker remembers
LONGEST_REMEMBERED = 256


class Codec:
    """What encoder and decoder share: merges, ids, the lookahead, remembered pre-tokens."""

    def __init__(self, path: str):
        held = vocabulary(path)
        self.arrays = Ranks(path)
        self.id_of = held.ids
        self.rank = {pair: r for r, pair in enumerate(held.merges)}
        self.lookahead = sufficient_lookahead(held.merges)
        self.special = held.special
        self.bytes_of = {i: t for t, i in held.ids.items()}
        self.bytes_of |= {i: name.encode() for name, i in held.special.items()}
        self.known: dict[str, bytes] = {}

    def tokens(self, piece: bytes) -> list[bytes]:
        """The tokens of one bounded piece: lowest rank first, leftmost first, by a heap."""
        rank, size = self.rank, len(piece)
        part: list = [piece[i : i + 1] for i in range(size)]
        after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
        heap = [(r, i) for i, p in enumerate(zip(part, part[1:])) if (r := rank.get(p)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if part[i] is None or j >= size or rank.get((part[i], part[j])) != r:
                continue
            part[i], part[j] = part[i] + part[j], None
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (r := rank.get((part[i], part[k]))) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank.get((part[h], part[i]))) is not None:
                heappush(heap, (r, h))
        return [p for p in part if p is not None]

    def packed(self, tokens: Iterable[bytes]) -> bytes:
        """Ids of the tokens as little-endian 32-bit integers."""
        return b"".join(pack("<I", self.id_of[t]) for t in tokens)

    def packed_pieces(self, batch: list[list[str | bytes]]) -> list[bytes]:
        """Per list, the ids of its pre-tokens; bytes in a list are ids already.

        Pre-tokens not remembered are merged first, those of all lists at once.
        """
        known = self.known
        items = set().union(*batch)
        if len(known) + len(items) > REMEMBERED:
            known.clear()
        pieces = [p for p in items.difference(known) if isinstance(p, str)]
        if pieces:
            ids, sizes = self.arrays.merged([p.encode() for p in pieces])
            raw, end = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
            known.update(zip(pieces, map(raw.__getitem__, map(slice, [0, *end], end))))
        ready = {p: p for p in items if isinstance(p, bytes)}
        known.update(ready)
        packed = [b"".join(map(known.__getitem__, items)) for items in batch]
        for item in ready:
            del known[item]
        return packed


class Encoder:
    """Feed text, get ids (little-endian 32-bit integers) as soon as they are settled."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.marker = next(iter(codec.special), "")
        self.text = ""  # not yet known to be free of the marker
        self.open = ""  # split, but its last matches are not settled
        self.run = ""  # kind of the open run whose bytes are already being merged
        self.piece = b""  # bytes of that run whose tokens are not stable

    def feed(self, text: str) -> bytes:
        return self.codec.packed_pieces([self.take(text)])[0]

    def finish(self) -> bytes:
        return self.codec.packed_pieces([self.take("", True)])[0]

    def take(self, text: str, last: bool = False) -> list[str | bytes]:
        """What of the input is settled now: pre-tokens to merge, or ids."""
        out: list[str | bytes] = []
        self.text += text
        while self.marker and (at := self.text.find(self.marker)) >= 0:
            self._split(self.text[:at], True, out)
            out.append(pack("<I", self.codec.special[self.marker]))
            self.text = self.text[at + len(self.marker) :]
        ready = len(self.text) - (0 if last else self._marker_start())
        self._split(self.text[:ready], last, out)
        self.text = self.text[ready:]
        return out

    def _marker_start(self) -> int:
        """Characters at the end that may begin the marker."""
        for size in range(min(len(self.marker) - 1, len(self.text)), 0, -1):
            if self.text.endswith(self.marker[:size]):
                return size
        return 0

    def _split(self, text: str, last: bool, out: list[str | bytes]) -> None:
        text, self.open = self.open + text, ""
        kinds = patterns(text)
        if self.run:
            text = self._follow(text, kinds, last, out)
            if self.run:
                return
        pieces = kinds["split"].findall(text)
        if not last:
            # A match is settled by a character behind it, and by three from its start on.
            settled, end = len(pieces), len(text)
            while settled:
                start = end - len(pieces[settled - 1])
                if end < len(text) and len(text) - start >= 3:
                    break
                settled, end = settled - 1, start
            self.open = "".join(pieces[settled:])
            del pieces[settled:]
        if max(map(len, pieces), default=0) <= LONGEST_REMEMBERED:
            out += pieces
        else:
            out += [p if len(p) <= LONGEST_REMEMBERED else self._long(p) for p in pieces]
        if len(self.open) > WINDOW:
            # That is one open run. Its bytes go to the merge stage as they come.
            self.run = _kind(self.open[-1], kinds)
            held = len(self.open) - (self.run == "space")
            self.piece, self.open = self.open[:held].encode(), self.open[held:]
            out.append(self._stable(False))

    def _follow(self, text: str, kinds: dict, last: bool, out: list) -> str:
        """Carry the open run on through `text`; returns what follows the run."""
        run = kinds[self.run].match(text)
        end = run.end() if run else 0
        ended = last or end < len(text)
        if self.run == "space" and end and not (last and end == len(text)):
            end -= 1  # a blank before other text begins the next pre-token
        self.piece += text[:end].encode()
        out.append(self._stable(ended))
        if ended:
            self.run = ""
            return text[end:]
        self.open = text[end:]
        return ""

    def _stable(self, ended: bool) -> bytes:
        """Tokens of the open piece that nothing to come can change; all if it has ended."""
        out, ahead = [], self.codec.lookahead
        while len(self.piece) > 2 * ahead or ended and self.piece:
            part = self.piece[: 4 * ahead + WINDOW]
            tokens, done = self.codec.tokens(part), 0
            stable = len(part) if ended and len(part) == len(self.piece) else len(part) - ahead
            for count, token in enumerate(tokens):
                if done + len(token) > stable:
                    del tokens[count:]
                    break
                done += len(token)
            out.append(self.codec.packed(tokens))
            self.piece = self.piece[done:]
        return b"".join(out)

    def _long(self, piece: str) -> bytes:
        """A settled pre-token too long to remember, through the same bounded stage."""
        outer, self.piece = self.piece, piece.encode()
        found = self._stable(True)
        self.piece = outer
        return found


def _kind(char: str, kinds: dict) -> str:
    return next(k for k in ("letter", "number", "space", "other") if kinds[k].match(char))


class Decoder:
    """Feed ids, get text; bytes that form no character become U+FFFD as the library has it."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.state.decode(b"".join(map(self.codec.bytes_of.__getitem__, ids.tolist())))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """Read once in a Python worker."""
    return Codec(path)


def encode_stream(parts: Iterable[str], path: str) -> Iterator[np.ndarray]:
    """Ids of the text that the parts add up to, part by part."""
    encoder = Encoder(codec(path))
    for part in parts:
        yield np.frombuffer(encoder.feed(part), "<u4")
    yield np.frombuffer(encoder.finish(), "<u4")


def decode_stream(ids: Iterable[np.ndarray], path: str) -> Iterator[str]:
    decoder = Decoder(codec(path))
    for part in ids:
        yield decoder.feed(part)
    yield decoder.finish()


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    for at in range(0, len(text), size):
        yield text[at : at + size]


def round_trip_digests(path: str):
    """A function from texts to [tokens, digest of ids, digest of decoded text] of each."""

    def digests(texts: list) -> list:
        shared = codec(path)
        counts = [0] * len(texts)
        of_ids, of_text = [sha256() for _ in texts], [sha256() for _ in texts]
        streams = [(i, Encoder(shared), Decoder(shared), chunks(t or "")) for i, t in enumerate(texts)]
        # All streams advance by one chunk a turn, so that their new pre-tokens merge together.
        while streams:
            turn = [(*s, next(s[3], None)) for s in streams]
            taken = [e.take(chunk or "", chunk is None) for _, e, _, _, chunk in turn]
            for (i, _, decoder, _, chunk), ids in zip(turn, shared.packed_pieces(taken)):
                counts[i] += len(ids) // 4
                of_ids[i].update(ids)
                of_text[i].update(decoder.feed(np.frombuffer(ids, "<u4")).encode())
                if chunk is None:
                    of_text[i].update(decoder.finish().encode())
            streams = [s for s, t in zip(streams, turn) if t[4] is not None]
        return [counts, [h.hexdigest() for h in of_ids], [h.hexdigest() for h in of_text]]

    return digests


def encode(
    documents: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every row; a null text has none, like an empty one."""

    def make():
        def ids(texts: list) -> list:
            streams = (encode_stream(chunks(t or ""), vocabulary_path) for t in texts)
            return [[np.concatenate([*s]).astype("i4") for s in streams]]

        return ids

    return map_texts(documents, [id_col], text_col, make, "ids array<int>")


def round_trip(
    documents: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded as streams.

    Ids are those of the library's `encode` without added tokens, the text that of its
    `decode` with special tokens kept. A null text counts as empty: no tokens, and digests of
    no bytes. Rows are treated one by one: repeated rows, ties and null ids come out as they
    came in, an empty table gives no rows, other columns are not read. The length of a text
    sets the time, not the state that is held.
    """
    return map_texts(
        documents,
        [id_col],
        text_col,
        lambda: round_trip_digests(vocabulary_path),
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
