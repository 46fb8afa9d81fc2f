"""Secret scan: fixed patterns plus a token-efficiency test.

A byte-pair vocabulary learnt from prose spends few tokens on words and many on
random strings. Every unbroken run of key characters is encoded; runs with few
characters per token are reported, unless they have the form of a known digest,
or that of an identifier whose letter groups themselves have enough characters
per token. Of a run that is not random as a whole, what its words between
separators leave is tested too. The pattern matches ("base" spans) are always
reported; what they leave of a run is tested as a run of its own.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_batch, slices, text_or_empty

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Runs of key characters of at least so many code points are tested.
MIN_CHARS = 20
#: A run with fewer characters per token than this is random.
MAX_RATIO = 2.2

#: What separators leave of a run, and the least letters of a part that is a word.
PART = re.compile(r"[^+/_=.-]+")
WORD_LETTERS = 3
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_CHARS)
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hex digits.
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
LABELLED_DIGEST = re.compile(r"(md5|sha1|sha256|sha384|sha512)[-=][A-Za-z0-9+/]+={0,2}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Words in camel, snake, kebab, dotted or path form, numbers and versions.
IDENTIFIER = re.compile(
    r"(?:[+/_=.-]*+(?:[A-Z]{2,}|[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*|[A-Z])?\d{0,8}(?=[+/_=.-]|$))*+[+/_=.-]*+"
)
NUMBER = re.compile(r"[0-9+/_=.-]+")
#: The letter groups of an identifier.
LETTERS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: An identifier with so few letters is a number with a mark (a version).
MARK_LETTERS = 2


@functools.cache
def encoding(path: str | None):
    """The tiktoken encoding of a rank file; by default the public 50k vocabulary."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_digest_or_number(run: str) -> bool:
    """True for digests and numbers: long, but not a secret by their form."""
    if DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    return any(p.fullmatch(run) for p in (UUID, LABELLED_DIGEST, NUMBER))


def is_known(run: str) -> bool:
    """True for the forms of digests, numbers and identifiers."""
    return is_digest_or_number(run) or IDENTIFIER.fullmatch(run) is not None


def is_words(run: str, enc, max_ratio: float) -> bool:
    """True for an identifier whose letter groups are no random letters."""
    if not IDENTIFIER.fullmatch(run):
        return False
    groups = LETTERS.findall(run)
    letters = sum(map(len, groups))
    return letters <= MARK_LETTERS or letters >= max_ratio * sum(len(enc.encode_ordinary(g)) for g in groups)


def is_random(run: str, enc, max_ratio: float) -> bool:
    """True for a run with few characters per token that is neither digest, number nor words."""
    if is_digest_or_number(run) or is_words(run, enc, max_ratio):
        return False
    return len(run) < max_ratio * len(enc.encode_ordinary(run))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in code points, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    # A run that is long enough is found whole either way, so the length stands in the pattern.
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_parts(run: str, enc, max_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run: the whole, else what words at its
    ends leave, else the stretches between words, else single parts."""
    if len(run) < MIN_CHARS or is_digest_or_number(run):
        return []
    if is_random(run, enc, max_ratio):
        return [(0, len(run))]
    parts = [m.span() for m in PART.finditer(run)]
    stretches, fresh = [], True
    for s, e in parts:
        if sum(map(len, LETTERS.findall(run[s:e]))) >= WORD_LETTERS and is_words(run[s:e], enc, max_ratio):
            fresh = True
        elif fresh:
            stretches.append((s, e))
            fresh = False
        else:
            stretches[-1] = stretches[-1][0], e

    def test(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return [(s, e) for s, e in spans if e - s >= MIN_CHARS and is_random(run[s:e], enc, max_ratio)]

    if found := test([(stretches[0][0], stretches[-1][1])] if stretches else []):
        return found
    found = test(stretches)
    alone = [(s, e) for s, e in test(parts) if not any(a <= s and e <= b for a, b in found)]
    return sorted(found + alone)


def random_spans(text: str, taken: list[tuple[int, int, int]], enc, max_ratio: float) -> list[tuple[int, int, int]]:
    """What is random in the runs, or in what the pattern matches leave of them."""
    found, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        pieces, free, end = [], max(m.start(), reach), m.end()
        # both lists ascend by start, so one pass keeps the furthest end before the run's
        while at < len(taken) and taken[at][0] < end:
            if taken[at][0] > free:
                pieces.append((free, taken[at][0]))
            reach = max(reach, taken[at][2])
            free = max(free, reach)
            at += 1
        if free < end:
            pieces.append((free, end))
        if pieces != [m.span()] and is_digest_or_number(m.group()):
            continue
        found += [(p + s, 3, p + e) for p, q in pieces for s, e in random_parts(text[p:q], enc, max_ratio)]
    return found


def scan_text(text: str, enc, max_ratio: float = MAX_RATIO):
    """(base spans, all spans), each sorted by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, enc, max_ratio))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
    max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_random,
    base_sha256 (digest of the joined pattern matches) and spans.

    Null text counts as empty: no spans, and the digest of the empty string.
    Null ids and repeated rows pass through, one output row for each input row;
    other columns are ignored. No shuffle; a task holds one slice of texts.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, kind)]
        + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path)
        for b in slices(batches):
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in b.column(1).to_pylist():
                base, found = scan_text(text, enc, max_ratio)
                kinds = [k for _, k, _ in found]
                for k, out in enumerate(counts):
                    out.append(kinds.count(k))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(found))
            rest = as_batch(
                {f"n_{k}": (counts[i], pa.int64()) for i, k in enumerate(KINDS)}
                | {"base_sha256": (digests, pa.string()), "spans": (spans, pa.string())}
            )
            yield pa.RecordBatch.from_arrays([b.column(0), *rest.columns], names=[id_col, *rest.schema.names])

    return docs.select(F.col(id_col), text_or_empty(text_col)).mapInArrow(scan, schema)


def redact(text: str, enc, mark: str = "[secret]", max_ratio: float = MAX_RATIO) -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in scan_text(text, enc, max_ratio)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", ranks_path: str | None = None, mark: str = "[secret]") -> DataFrame:
    """The documents with secrets replaced; all columns and rows stay, null text stays null."""
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path)
        for b in slices(batches):
            texts = [None if t is None else redact(t, enc, mark) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    # by position: any column name goes
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(clean, numbered.schema).toDF(*docs.columns)
