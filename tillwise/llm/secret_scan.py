"""Secret scans: token efficiency.

Prose costs a byte-level vocabulary one token for three characters or more; random strings cost
one for less than two. A run of code characters with a low ratio of characters to tokens is taken
for a secret, unless it looks like a digest, a UUID, a date or a number. An identifier made of words
and separators must have a still lower ratio. Runs of letters only are judged like others, and so
are four or more groups of equal length, as keys are dealt in. Three fixed kinds come first and always stay: assignments to secret names, access keys and
long hexadecimal runs. The method adds spans of kind ``random`` where none of them lies.

Spans are (kind, start, end) in code points, end exclusive. Null texts have none.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W

ASSIGN, ACCESS, HEX, RANDOM = "assign", "access", "hex", "random"
KINDS = (ASSIGN, ACCESS, HEX, RANDOM)
_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, RUN_LEAST = 6, 20, 24, 20

#: Characters per token below which a run counts as random.
RATIO = 1.9
#: The same for identifiers made of words and separators.
IDENTIFIER_RATIO = 1.45
#: So many parts of one length are the groups of a key.
KEY_GROUPS = 4
#: Hexadecimal digits of the usual digests (MD5, SHA-1, SHA-2).
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_HEX_ANY_CASE = re.compile(r"[0-9a-fA-F]+")
#: A digest that says so itself, as in integrity attributes and image names.
_NAMED_DIGEST = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512))[-_=/][A-Za-z0-9+/=]+", re.IGNORECASE)
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_NUMBERS = re.compile(r"[0-9+/_=-]*")
_WORDY = re.compile(r"([A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4})([_/=+-]*([A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]{1,4}))*")


def _table(characters: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[[ord(c) for c in characters]] = 1
    return table


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_HEX_BYTES = _table(_DIGITS + "abcdef")
_RUN_BYTES = _table(_DIGITS + _LOWER + _LOWER.upper() + "+/_=-")


def _rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encodings: dict[str, object] = {}


def _encoding(path: str):
    """The vocabulary, read once for each worker process."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encodings[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def is_fixed_form(run: str) -> bool:
    """Digests, UUIDs, numbers and dates."""
    if _HEX_ANY_CASE.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(_NAMED_DIGEST.fullmatch(run) or _UUID.fullmatch(run) or _NUMBERS.fullmatch(run))


def is_identifier(run: str) -> bool:
    """Words, single letters and short numbers between separators, not in groups of one length."""
    parts = [p for p in re.split(r"[_/=+-]+", run) if p]
    if len(parts) >= KEY_GROUPS and len({len(p) for p in parts}) == 1:
        return False
    return len(parts) > 1 and all(_WORDY.fullmatch(p) or len(p) == 1 for p in parts)


def is_known_form(run: str) -> bool:
    """Digests, UUIDs, numbers and dates, and identifiers made of words and short numbers."""
    return is_fixed_form(run) or is_identifier(run)


def is_random(run: str, encoding) -> bool:
    if is_fixed_form(run):
        return False
    return len(run) < (IDENTIFIER_RATIO if is_identifier(run) else RATIO) * len(encoding.encode_ordinary(run))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        found += [(ASSIGN, *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(ACCESS, *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [(HEX, *m.span()) for m in _HEX.finditer(text)]


def _in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_spans(text: str, encoding) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then by kind."""
    found = base_spans(text)
    base = list(found)
    for m in _RUN.finditer(text):
        if not any(s < m.end() and m.start() < e for _, s, e in base) and is_random(m[0], encoding):
            found.append((RANDOM, *m.span()))
    return _in_order(found)


def _may_hold(texts: pa.Array) -> np.ndarray:
    """Rows with a long enough run of hexadecimal or code characters."""
    data, first = W.text_bytes(texts)
    out = np.zeros(len(first) - 1, bool)
    for table, least in ((_HEX_BYTES, HEX_LEAST), (_RUN_BYTES, RUN_LEAST)):
        starts, ends = W.spans(data, first, table)
        long = starts[ends - starts >= least]
        out[np.searchsorted(first, long, "right") - 1] = True
    return out


def batch_spans(texts: pa.Array, encoding) -> list[list[tuple[str, int, int]]]:
    """Spans of every text; the byte classes of the whole batch rule most texts out at once."""
    out = []
    for text, runs in zip(texts.to_pylist(), _may_hold(texts).tolist()):
        if not text:
            out.append([])
        elif runs:
            out.append(secret_spans(text, encoding))
        else:
            lower = text.lower()
            out.append(_in_order(base_spans(text)) if "AKIA" in text or any(name in lower for name in _NAMES) else [])
    return out


def find_secrets(documents: DataFrame, rank_file: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), for every row."""
    path = rank_file or _rank_file()

    def scanned(batches):
        encoding = _encoding(path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in W.pieces(batches, 1):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in batch_spans(batch.column(1), encoding)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scanned, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the fixed kinds' spans, and all spans as text."""
    one = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != RANDOM)
    return found.select("doc_id", *(one(kind) for kind in KINDS[:3]), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), one(RANDOM))


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each stretch of overlapping spans replaced by the kind of its first one."""
    if not spans:
        return text
    out, at, end = [], 0, -1
    for kind, start, stop in spans:
        if start >= end:
            out += [text[at : max(start, at)], f"[{kind}]"]
        end = max(end, stop)
        at = end
    return "".join(out) + text[at:]


def redact_secrets(documents: DataFrame, rank_file: str | None = None) -> DataFrame:
    """The documents, same columns, with secrets in ``text`` replaced and ``n_chars`` counted anew."""
    path = rank_file or _rank_file()
    schema = documents.schema
    at = documents.columns.index("text")

    def cleaned(batches):
        encoding = _encoding(path)
        for batch in W.pieces(batches, at):
            texts = batch.column(at)
            clean = [redact(t, s) for t, s in zip(texts.to_pylist(), batch_spans(texts, encoding))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, texts.type))

    out = documents.mapInArrow(cleaned, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in documents.columns else out
