"""Secret spans in whole texts: three fixed patterns, and strings that a token vocabulary compresses badly."""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map
from .tokens import vocabulary_path

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Runs that the token-efficiency test looks at; shorter ones say too little.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Signs that join words, and a secret to what stands beside it.
JOINTS = "+/_=-"
LEAST = 20
#: Strings that look random and are no secrets: digests of usual lengths, UUIDs, numbers, words joined by signs.
#: All repeats are possessive, as no part can begin where the one before might go on: it takes time in proportion to the length.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{48}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[-0-9_/+=]+|[A-Za-z]?+[a-z]*+(?:[-_/=+][A-Za-z]?+[a-z]*+)*+|[A-Z]++(?:[-_/=+][A-Z]*+)*+"
    r"|(?:[A-Z]{0,3}+[a-z]++)++)"
)

Span = tuple[int, int, int]  # kind's number, start, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping within a kind, in code points."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def uncovered(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans leave of start to end."""
    parts = []
    for s, e in sorted(spans):
        if s > start:
            parts.append((start, s))
        start = max(start, e)
    return [*parts, (start, end)] if start < end else parts


class TokenEfficiency:
    """Flags runs whose characters per token fall below ``ratio``: text that the vocabulary was learned
    from merges into long tokens, random strings do not."""

    def __init__(self, vocabulary: str, ratio: float) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ratio = ratio

    def random(self, run: str) -> bool:
        return not KNOWN.fullmatch(run) and len(run) < self.ratio * len(self.coder.encode_ordinary(run))

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Random runs, and of runs that base spans touch the parts that these leave uncovered."""
        found: list[Span] = []
        for m in RUN.finditer(text):
            touching = [(s, e) for _, s, e in base if s < m.end() and m.start() < e]
            if not touching:
                found += [(3, m.start(), m.end())] if self.random(m[0]) else []
                continue
            for start, end in uncovered(m.start(), m.end(), touching):
                part = text[start:end]
                # joints beside a base span belong to neither
                part = part.lstrip(JOINTS) if start > m.start() else part
                part = part.rstrip(JOINTS) if end < m.end() else part
                part = part if len(part) >= LEAST else text[start:end]
                if len(part) >= LEAST and self.random(part):
                    at = text.index(part, start)
                    found.append((3, at, at + len(part)))
        return found


def rendered(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])))


def scan_secrets(df: DataFrame, ratio: float = 2.0, vocabulary: str | None = None) -> DataFrame:
    """A row for each row of (doc_id, text): counts a kind, base_sha256 of the base spans, all spans.

    Null text counts as empty: no spans, and the digest of the empty string. Null doc_ids and repeated
    rows are scanned like others; an empty table gives no rows; other columns are ignored.
    """
    path = vocabulary or vocabulary_path("byte_bpe_50k.tiktoken")

    def make():
        efficiency = TokenEfficiency(path, ratio)

        def work(batch):
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")}
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = efficiency.spans(text or "", base)
                for i, k in enumerate(KINDS):
                    out[f"n_{k}"].append(sum(s[0] == i for s in base + more))
                out["base_sha256"].append(hashlib.sha256(rendered(base).encode()).hexdigest())
                out["spans"].append(rendered(base + more))
            yield out | {"doc_id": batch.column(0)}

        return work

    return arrow_map(df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redact_secrets(df: DataFrame, ratio: float = 2.0, vocabulary: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """df with each secret of ``text`` replaced by ``mark``, overlapping spans by one, and n_chars, where
    there is such a column, made to fit. All rows and columns stay; texts without secrets stay as they are, null too."""
    path = vocabulary or vocabulary_path("byte_bpe_50k.tiktoken")
    names = df.columns
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names else None

    def make():
        efficiency = TokenEfficiency(path, ratio)

        def work(batch):
            texts, sizes = batch.column(at).to_pylist(), batch.column(size).to_pylist() if size is not None else []
            for i, text in enumerate(texts):
                if text and (base := base_spans(text)) + (more := efficiency.spans(text, base)):
                    texts[i] = redacted(text, base + more, mark)
                    if size is not None:
                        sizes[i] = len(texts[i])
            out = {c: batch.column(i) for i, c in enumerate(names)}
            yield out | {"text": texts} | ({"n_chars": sizes} if size is not None else {})

        return work

    return arrow_map(df, make, df.schema)


def redacted(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda x: x[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
