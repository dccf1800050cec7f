"""Secrets in texts: fixed patterns, and random strings shown by few characters per token.

A vocabulary trained on prose spends few tokens on words and names but one for every one or two characters of a random
string. A long unbroken run of key characters with fewer than ``RATIO`` characters a token is reported as ``random``; of
any other run the stretches of ``LEAST_RANDOM`` letters and digits or more with so few characters a token are, since a
random value may be glued to prose by separators or by nothing. Separators and numbers between them count for nothing in a
stretch. Digests of a known length, UUIDs, numbers and the spans of the fixed patterns are never part of one.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.byte_bpe import read_ranks

#: The three base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

LEAST_RUN, LEAST_RANDOM = 20, 16
RUN = re.compile(f"[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}")
#: Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512; the form of a UUID; plain numbers.
KNOWN = re.compile(
    r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})"
    r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[0-9_=+/-]+"
)
RATIO = 2.0
KINDS = ("assign", "access", "hex")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, kind, end)`` by start, then kind as listed; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


#: A UUID inside a run, or a part of a run between separators.
PART = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])|[0-9A-Za-z]+")


def stretches(tokens: list[tuple[int, int]], ratio: float) -> list[tuple[int, int]]:
    """Disjoint stretches ``(start, end)`` of the tokens' places with ``LEAST_RANDOM`` characters or more, fewer than ``ratio`` a token.

    A stretch begins where what it gains over ``ratio`` is most and goes on as long as that grows.
    """
    chars, gains = [0], [0.0]
    for start, end in tokens:
        chars.append(chars[-1] + end - start)
        gains.append(gains[-1] + ratio - (end - start))
    found, first, ready, best, j = [], 0, 0, None, 1
    while j < len(chars):
        while ready < j and chars[ready] <= chars[j] - LEAST_RANDOM:
            if ready >= first and (best is None or gains[ready] <= gains[best]):
                best = ready
            ready += 1
        if best is not None and gains[j] > gains[best]:
            last, k = j, j + 1
            while k < len(chars) and gains[k] > gains[best]:
                last, k = k if gains[k] > gains[last] else last, k + 1
            found.append((tokens[best][0], tokens[last - 1][1]))
            first = ready = j = last
            best = None
        j += 1
    return found


def random_spans(text: str, base: list[tuple[int, str, int]], coder, ratio: float) -> list[tuple[int, str, int]]:
    found, at = [], 0
    held = sorted((start, end) for start, _, end in base)
    for m in RUN.finditer(text):
        if KNOWN.fullmatch(m[0]):
            continue
        while at < len(held) and held[at][1] <= m.start():
            at += 1
        taken, k = [], at
        while k < len(held) and held[k][0] < m.end():
            if held[k][1] > m.start():
                taken.append((max(held[k][0], m.start()), min(held[k][1], m.end())))
            k += 1
        if not taken and len(m[0]) >= LEAST_RUN and not any(KNOWN.fullmatch(p) and not p.isdigit() for p in PART.findall(m[0])):
            if len(m[0]) < ratio * len(coder.encode_ordinary(m[0])):
                found.append((m.start(), "random", m.end()))
                continue
        free, start = [], m.start()
        for low, high in taken:
            free.append((start, low))
            start = max(start, high)
        for start, end in [*free, (start, m.end())]:
            tokens: list[tuple[int, int]] = []
            whole = []
            for part in PART.finditer(text, start, end):
                if part[0].isdigit():
                    continue
                if KNOWN.fullmatch(part[0]):
                    whole.append(tokens)
                    tokens = []
                    continue
                place = part.start()
                for token in coder.encode_ordinary(part[0]):
                    tokens.append((place, place + len(coder.decode_single_token_bytes(token))))
                    place = tokens[-1][1]
            for tokens in [*whole, tokens]:
                found += [(low, "random", high) for low, high in stretches(tokens, ratio)]
    return found


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, path: str, pattern: str, ratio: float = RATIO, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans)``, a row for each row of ``docs``.

    A null or empty text has no spans. Repeated rows are scanned each time, and no other column plays a part. Whole
    texts are read in one pass whose time follows their length.
    """

    def scan(batches):
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = base_spans(body)
                spans = sorted([*base, *random_spans(body, base, coder, ratio)], key=lambda s: s[0])
                counts = [sum(kind == k for _, kind, _ in spans) for k in (*KINDS, "random")]
                rows.append((doc, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(scan, ", ".join(f"{n} {'string' if n in ('base_sha256', 'spans') else 'long'}" for n in NAMES))


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
