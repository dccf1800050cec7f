"""Byte-level BPE by a lazily determinised transducer, and decoding by an incremental UTF-8 state machine.

A tokenization is the one BPE gives exactly when every two neighbouring tokens are what BPE gives for their joined
bytes. So a nondeterministic transducer can read bytes along a trie of the vocabulary and, at the end of any token that
fits the token before it, start again at the root; one path survives at each position. A deterministic state is the
set of live paths, each with its place in the trie, the token before it and where it began; a transition also names the
one token that can end there. A token is emitted once all live paths have it behind them, which is after at most the
longest token's bytes. States and transitions are made when first needed, and forgotten together when there are too many.
A Python worker keeps its transducer and the stretches it has met from task to task.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES_HELD = 400_000
PIECES_HELD = 500_000  # of each of two generations
PAIRS_HELD = 1_000_000
#: White space as the rank files' own library reads ``\\s``.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str) -> regex.Pattern:
    """``pattern`` with its white-space classes spelt out, since libraries differ over the control characters."""
    inside = pattern.replace(r"[^\s", f"[^{WHITE}")
    return regex.compile(inside.replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


class State(dict):
    """A set of live paths and the states made from it so far, by byte. The token that has just ended is that of the path at the root."""

    __slots__ = ("__weakref__", "live", "machine", "size", "token")

    def __init__(self, machine: Transducer, live: tuple):
        super().__init__()
        self.machine, self.live, self.token = machine, live, live[-1][1]
        self.size = len(machine.tokens.get(self.token, b""))

    def __missing__(self, byte: int) -> State:
        state = self[byte] = self.machine._hop(self.live, byte)
        return state


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(None)
            self.token_at[node] = rank
        self.fitting: dict[tuple[int | None, int], bool] = {}
        self.built: dict[int, tuple] = {}
        self.states: dict[tuple, State] = {}
        self._forget()

    def _forget(self) -> None:
        """Drop all states and transitions; one that is being walked goes on and makes new ones."""
        for state in self.states.values():
            state.clear()
        self.states.clear()
        self.start = self._state(((0, None, 0),))

    def _state(self, live: tuple) -> State:
        state = self.states.get(live)
        if state is None:
            state = self.states[live] = State(self, live)
        return state

    def _merge(self, data: bytes) -> tuple[list[bytes], list, list]:
        """BPE by its definition, lowest rank first and leftmost among equals: the parts, and what stood at the left
        and at the right end meanwhile, each as ``(part, rank of the merge that takes it)``."""
        parts, ends = [data[k : k + 1] for k in range(len(data))], ([], [])
        none = len(self.tokens)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, none), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == none:
                break
            if at == 0:
                ends[0].append((parts[0], rank))
            if at == len(parts) - 2:
                ends[1].append((parts[-1], rank))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, [*ends[0], (parts[0], none)], [*ends[1], (parts[-1], none)]

    def _edges(self, token: int) -> tuple | None:
        """The left and the right edge of a token while BPE builds it; None where BPE does not build it, or takes a
        lower rank after a higher one, so that ranks do not tell the time."""
        if token not in self.built:
            parts, left, right = self._merge(self.tokens[token])
            rising = all(edge == sorted(edge, key=lambda e: e[1]) for edge in (left, right))
            self.built[token] = (left, right) if len(parts) == 1 and rising else None
        return self.built[token]

    def fits(self, last: int | None, token: int) -> bool:
        """Whether BPE of the two tokens' joined bytes is the two tokens."""
        known = self.fitting.get((last, token))
        if known is None:
            if len(self.fitting) >= PAIRS_HELD:
                self.fitting.clear()
            known = self.fitting[last, token] = self._fits(last, token)
        return known

    def _fits(self, last: int | None, token: int) -> bool:
        pair = [token] if last is None else [last, token]
        edges = [self._edges(t) for t in pair]
        if None in edges:
            return self._merge(b"".join(self.tokens[t] for t in pair))[0] == [self.tokens[t] for t in pair]
        if last is None:
            return True
        before, after = edges[0][1], edges[1][0]
        for left, taken_left in before:
            for right, taken_right in after:
                rank = self.ranks.get(left + right)
                if rank is not None and rank < taken_left and rank <= taken_right:
                    return False
        return True

    def _hop(self, paths: tuple, byte: int) -> State:
        live, ended = [], None
        for node, last, back in paths:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token_at[child]
            if token is not None and self.fits(last, token):
                ended = token
            if self.children[child]:
                live.append((child, last, back + 1))
        if ended is None:
            raise ValueError(f"the vocabulary has no token for byte {byte} here")
        live.append((0, ended, 0))
        state = tuple(live)
        if len(self.states) >= STATES_HELD and state not in self.states:
            self._forget()
        return self._state(state)

    def _back(self, path: list[State], at: int, stop: int) -> list[int]:
        """The tokens between two positions of one path, read from the token that ends at each position."""
        out = []
        while at > stop:
            ended = path[at - 1]
            out.append(ended.token)
            at -= ended.size
        return out[::-1]

    def stream(self, data) -> Iterator[int]:
        """The tokens of one piece, each once every live path has it: after at most the longest token's bytes."""
        state, path, sent = self.start, [], 0
        for byte in data:
            state = state[byte]
            path.append(state)
            if len(path) % 64 == 0:
                starts = {len(path) - back for _, _, back in state.live}
                while len(starts) > 1:  # step the latest back until all paths meet
                    late = max(starts)
                    starts.remove(late)
                    starts.add(late - path[late - 1].size)
                met = starts.pop()
                yield from self._back(path, met, sent)
                sent = max(sent, met)
        yield from self._back(path, len(path), sent)

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 64:
            return list(self.stream(piece))
        state = self.start
        return self._back([state := state[byte] for byte in piece], len(piece), 0)


def _lead(byte: int) -> tuple[int, int, int] | None:
    """``(continuations, least, most)`` for a lead byte; the bounds hold for the byte after it."""
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


def utf8_step(held: bytes, byte: int) -> tuple[bytes, str]:
    """One byte of the UTF-8 state machine; the state is the unfinished character's bytes so far."""
    out = ""
    if held:
        missing, least, most = _lead(held[0])
        if len(held) > 1:
            least, most = 0x80, 0xBF
        if least <= byte <= most:
            held += bytes([byte])
            return (held, "") if len(held) <= missing else (b"", held.decode())
        out = "\ufffd"
    lead = _lead(byte)
    if lead is None:
        return b"", out + "\ufffd"
    return (bytes([byte]), out) if lead[0] else (b"", out + chr(byte))


class StreamDecoder:
    """Token ids in, text out as soon as its characters are whole; ill-formed bytes become U+FFFD.

    What a token does to a state is worked out byte by byte once and then remembered in ``steps``.
    """

    def __init__(self, tokens: dict[int, bytes], steps: dict[bytes, dict[int, tuple[bytes, str]]] | None = None):
        self.tokens, self.held = tokens, b""
        self.steps = {} if steps is None else steps

    def _step(self, token: int) -> tuple[bytes, str]:
        held, out = self.held, []
        for byte in self.tokens[token]:
            held, text = utf8_step(held, byte)
            out.append(text)
        step = self.steps.setdefault(self.held, {})[token] = (held, "".join(out))
        return step

    def feed(self, ids) -> str:
        out = []
        for token in ids:
            try:
                self.held, text = self.steps[self.held][token]
            except KeyError:
                self.held, text = self._step(token)
            out.append(text)
        return "".join(out)

    def end(self) -> str:
        left, self.held = "\ufffd" if self.held else "", b""
        return left


class Codec:
    """Whole texts to ids and back, with a bounded memory of stretches between spaces."""

    def __init__(self, path: str, pattern: str):
        self.machine = Transducer(read_ranks(path))
        self.pattern = splitter(pattern)
        self.awkward = regex.compile(f"\\x20(?:[{WHITE}]|$)")
        self.names = {rank: f"{rank} " for rank in self.machine.tokens}
        self.held: dict[str, tuple[str, str]] = {}  # by stretch its ids, each with a space behind, and the text they stand for
        self.old: dict[str, tuple[str, str]] = {}
        self.steps: dict[bytes, dict[int, tuple[bytes, str]]] = {}

    def stretches(self, text: str) -> list[str]:
        """Parts whose pieces do not depend on each other: a single space before a word always starts a piece."""
        if self.awkward.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + part for part in rest]]

    def ids(self, text: str) -> list[int]:
        return [token for piece in self.pattern.findall(text) for token in self.machine.encode(piece.encode())]

    def decode(self, ids) -> str:
        decoder = StreamDecoder(self.machine.tokens, self.steps)
        return decoder.feed(ids) + decoder.end()

    def digest(self, text: str) -> tuple[int, str, str]:
        stretches, held, old = self.stretches(text), self.held, self.old
        new = set(stretches).difference(held)
        if len(held) + len(new) > PIECES_HELD:
            self.old, self.held = old, held = held, {}
            new = set(stretches)
        for stretch in new:
            known = old.get(stretch)
            if known is None:
                ids = self.ids(stretch)
                known = "".join([self.names[i] for i in ids]), self.decode(ids)
            held[stretch] = known
        found = [held[stretch] for stretch in stretches]
        named, decoded = "".join([f[0] for f in found]), "".join([f[1] for f in found])
        return named.count(" "), hashlib.sha256(named[:-1].encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """The codec of this Python worker, with what it has met."""
    return Codec(path, pattern)


@contextmanager
def uncollected():
    """Without the cyclic collector, which would walk all states again and again; their own links are cut when they are forgotten."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _slim(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)`` for every row; a null or empty text has no ids. Repeated rows are encoded each time."""

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            with uncollected():
                ids = [own.ids(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _slim(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text."""

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            with uncollected():
                texts = [own.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded, its ids decoded, both digested.

    A null or empty text has no tokens. Repeated rows are coded each time; other columns play no part; an empty table gives
    an empty result.
    """

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            with uncollected():
                found = [own.digest(t) for t in batch.column(1).to_pylist()]
            counts, names, texts = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _slim(docs, key, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
