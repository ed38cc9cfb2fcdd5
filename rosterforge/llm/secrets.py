"""Secret scan: fixed patterns, and strings in a sensitive place that a primed compressor cannot shorten."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import id_schema, small_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_MIN, ACCESS_MIN = 12, 18
KINDS = ("assign", "access", "hex", "novel")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Novelty: what a candidate looks like, where it must stand, and how much of it must be new.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"pass(?:wd|word|phrase)?\b|pwd|secret|token|credential|auth|bearer|private|signing|key\b", re.I)
KEY_HEADER = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----")
_KEY_BODY = re.compile(r"[A-Za-z0-9+/=\s]*")
_SENSITIVE_BYTES = re.compile(SENSITIVE.pattern.encode(), re.I)
LOOK_BACK = 48             # characters before a candidate in which a sensitive word must stand
CONTEXT = 256              # characters on each side that may explain a candidate
NOVELTY = 0.7              # least marginal compressed bytes per character
LETTERS_NOVELTY = 0.8      # of candidates without a digit
DICTIONARY_ENTRIES = 4_000 # corpus identifiers in the dictionary, most documents first
MIN_DOCS = 3
# Identifiers that any code may hold.
COMMON_IDENTIFIERS = (
    "access_token api_key authorization bearer client_id client_secret config connection_string credentials "
    "database_url default environment export function import master_key password private_key public_key "
    "refresh_token request response return secret_key self session_id signature signing_key username value"
)
_HEX_MAP = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_IDENTIFIER = re.compile(r"[A-Za-z]+(?:_[A-Za-z]+)+")


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points, by start and then kind.

    Cheap byte searches decide which patterns a text can match at all; they never lose one.
    """
    low = data.lower()
    assign = any(k in low for k in _KEYWORDS)
    access, long_hex = b"AKIA" in data, b"x" * 16 in data.translate(_HEX_MAP)
    if not (assign or access or long_hex):
        return []
    text, found = data.decode("utf-8", "replace"), []
    if assign:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if access:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    if long_hex:
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


class Novelty:
    """Marginal compressed size of a string, given its surroundings and a dictionary."""

    def __init__(self, dictionary: bytes) -> None:
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False)

    def marginal(self, before: str, candidate: str, after: str) -> float:
        """Extra bytes per character that the candidate costs next to its surroundings."""
        around = (before + after).encode("utf-8", "replace")
        size = len(self.compressor.compress(around + candidate.encode()))
        return (size - len(self.compressor.compress(around))) / len(candidate)

    def spans(self, data: bytes, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates in a sensitive place that are new to the dictionary and to their surroundings.

        A place is sensitive where a telling word stands shortly before it, on its line or the
        line above, or inside a private key block. Other copies of a candidate are taken
        out of its surroundings, so that a secret that stands twice does not explain itself.
        """
        if not _SENSITIVE_BYTES.search(data):
            return []
        text, found = data.decode("utf-8", "replace"), []
        blocks = list(_key_blocks(text))
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            word = m[0]
            look = text[max(0, start - LOOK_BACK) : start]
            look = look[look.rfind("\n", 0, max(look.rfind("\n"), 0)) + 1 :]
            if not (SENSITIVE.search(look) or any(a <= start < b for a, b in blocks)):
                continue
            if any(s < end and start < e for _, s, e in base):
                continue
            before = text[max(0, start - CONTEXT) : start].replace(word, " ")
            after = text[end : end + CONTEXT].replace(word, " ")
            if self.marginal(before, word, after) >= least_novelty(word):
                found.append(("novel", start, end))
        return found


def least_novelty(word: str) -> float:
    """Marginal bytes per character that make a candidate novel; letters alone must be less like a word."""
    return LETTERS_NOVELTY if word.isalpha() else NOVELTY


def _key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Where private key blocks lie: from the header to the end mark, or as far as it looks like one."""
    for m in KEY_HEADER.finditer(text):
        end = text.find("-----END", m.end())
        yield m.end(), end if end >= 0 else _KEY_BODY.match(text, m.end()).end()


def identifier_dictionary(docs: DataFrame, text_col: str = "text") -> bytes:
    """Identifiers that at least MIN_DOCS of all documents hold, the most common last.

    Letters only, so that no secret gets in however often it is copied. Documents are counted in
    Spark; at most DICTIONARY_ENTRIES names reach the driver.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, int] = {}
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                if data and b"_" in data:
                    for name in set(_IDENTIFIER.findall(data.decode("utf-8", "replace"))):
                        seen[name] = seen.get(name, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["name", "n"]
            )

    top = (
        docs.select(F.col(text_col).cast("string")).mapInArrow(run, "name string, n bigint")
        .filter(F.length("name") <= 64).groupBy("name").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCS)
        .orderBy(F.desc("n"), "name").limit(DICTIONARY_ENTRIES)
    )
    names = [r["name"] for r in top.collect()]
    return " ".join([*names[::-1], COMMON_IDENTIFIERS]).encode()


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_novel) for every row.

    Whole texts are searched; a null text is an empty one. `spans` are the base spans and the
    novel ones, `kind:start:end` by start and then kind. Rows are judged on their own, so
    repeated ids stay repeated.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            out = []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                base = base_spans(data or b"")
                new = novelty.spans(data or b"", base)
                every = sorted([*base, *new], key=lambda s: (s[1], KINDS.index(s[0])))
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), len(new)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]
            )

    counts = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, id_schema(docs, id_col, counts))
