"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

Natural words cost few tokens for their characters under a byte-pair vocabulary; random keys
cost many. A stretch of key characters whose characters per token fall below ``least_ratio`` is a
span of kind ``random``, also beside ordinary words in one run. What a known digest (32, 40, 64 or
128 hex digits, or with a name before it), an identifier (UUID) or a span of the patterns covers is
taken out of the run, and the rest is tested.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import given_id, own_id

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Characters of the shortest key; the test asks for a letter as well.
LEAST = 20
SEPARATORS = "/_=-"
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
KNOWN = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    r"|(?:(?:md5|sha1|sha256|sha512)[-_=]?)?(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{128}))(?![0-9A-Za-z])",
    re.I,
)


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    """A tiktoken encoding from a file of ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, leftmost and non-overlapping within each kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def costly(run: str, path: str, least_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the stretches of at least ``LEAST`` characters with fewer than ``least_ratio`` to a token.

    The whole run if it is one. Else a stretch starts where it gains most, ends where it gains most before
    its ratio is lost, and is carried on to the next separators if its ratio stays.
    """
    tokens = encoding(path).encode_ordinary(run)
    if len(run) / len(tokens) < least_ratio:
        return [(0, len(run))]
    at, gain = [0], [0.0]
    for token in encoding(path).decode_tokens_bytes(tokens):
        at.append(at[-1] + len(token))
        gain.append(gain[-1] + least_ratio - len(token))
    found, begin, n = [], 0, len(at)
    while at[-1] - at[begin] >= LEAST:
        low, k, last = begin, begin, None
        for j in range(begin + 1, n):
            if last is None:
                while at[j] - at[k] >= LEAST:
                    low = k if gain[k] < gain[low] else low
                    k += 1
                if k > begin and gain[j] > gain[low]:
                    last = j
            elif gain[j] <= gain[low]:
                break
            elif gain[j] > gain[last]:
                last = j
        if last is None:
            break
        a, b = low, last
        while a > begin and run[at[a] - 1] not in SEPARATORS:
            a -= 1
        a = a if gain[last] > gain[a] else low
        while b < n - 1 and run[at[b]] not in SEPARATORS:
            b += 1
        b = b if gain[b] > gain[a] else last
        found.append((at[a], at[b]))
        begin = b
    return found


def random_spans(text: str, taken: list[tuple[int, int, int]], path: str, least_ratio: float) -> list[tuple[int, int, int]]:
    """(start, 3, end) of stretches that cost too many tokens, outside the spans of ``taken``."""
    found = []
    for m in RUN.finditer(text):
        covered = [(a, b) for a, _, b in taken if a < m.end() and m.start() < b]
        covered += [k.span() for k in KNOWN.finditer(text, m.start(), m.end())]
        start = m.start()
        for a, b in [*sorted(covered), (m.end(), m.end())]:
            if a - start >= LEAST:
                spans = [(start + x, start + y) for x, y in costly(text[start:a], path, least_ratio)]
                found += [(x, 3, y) for x, y in spans if any(c.isalpha() for c in text[x:y])]
            start = max(start, b)
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SPANS = T.StructType(
    [
        T.StructField("_id", T.LongType()),
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("n_random", T.LongType()),
        T.StructField("base_spans", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
)


def scan(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", least_ratio: float = 2.0) -> DataFrame:
    """One row per document: doc_id, counts by kind, base_spans and all spans as text.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. NULL and
    empty texts have none; rows are independent, so repeated rows repeat their result. Other columns are not looked
    at; an empty table gives an empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                every = sorted(base + random_spans(text, base, vocabulary, least_ratio))
                for k in range(4):
                    out[k].append(sum(kind == k for _, kind, _ in every))
                out[4].append(listed(base))
                out[5].append(listed(every))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(a, k) for a, k in zip(out, kinds))], names=SPANS.names)

    rows = docs.select(own_id(id_column).alias("_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(each, SPANS).select(given_id().alias("doc_id"), *SPANS.names[1:])
