"""Secrets by patterns and by dictionary-primed zstandard novelty.

Beside the base patterns, long strings near a sensitive word or next to a found secret are measured: how many bytes does one add to a
zstandard frame whose dictionary holds the code around it and common identifiers? Words and identifiers that
occur nearby cost little; a random string costs about its own length and is reported.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tideline.llm.frames import id_and_text, map_arrow

# The base kinds, in their order, with the least length of what must be long.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # whole runs of [0-9a-f]+ with 16 or more characters
KINDS = ["assign", "access", "hex", "novel"]
_CODED = 64  # zstandard leaves fewer literals than this as they are
_BEHIND = 1500  # so much of a long candidate is known to its next piece

_SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|bearer|credential|private|cookie|session|signature|login", re.IGNORECASE | re.ASCII)
LEAST = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{LEAST},}}")
_SHAPE = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.DOTALL)
_BETWEEN = re.compile(r"(?:\\[nrt]|[\W_])*+")  # white space, quotes and separators, also as escapes
_TAIL = re.compile(r"(?:\\[nrt]|[\W_])*+([A-Za-z0-9+/=]+)(?:\\[nrt]|[^\w-])*+-----END")  # a key's last line
IDENTIFIERS = (
    "import return class function public private static const string value config settings options default "
    "request response header headers content application json authorization bearer basic username password "
    "passwd secret token api_key apikey access_key secret_key client_id client_secret private_key public_key "
    "session cookie signature login database connection host port user email name index length error message "
    "localhost http https www example com org net amazonaws google github version timestamp created updated "
    "true false null none undefined 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
).encode()


def marginal_bytes(candidate: str, around: str) -> int:
    """Bytes that the candidate adds to frames primed with ``around``, the identifiers and its own last characters.

    It is measured in pieces of equal size under ``_CODED`` bytes: from there on zstandard also Huffman-codes what
    it has not seen, and a random string over few symbols would cost less than its length.
    """
    parameters = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    size = -(-len(candidate) // -(-len(candidate) // (_CODED - 1)))
    added = 0
    for at in range(0, len(candidate), size):
        beside = f"{around} {candidate[max(0, at - _BEHIND) : at]}" if at else around
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + beside.encode(errors="replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        frame = zstandard.ZstdCompressor(dict_data=primed, compression_params=parameters)
        added += len(frame.compress(candidate[at : at + size].encode())) - len(frame.compress(b""))
    return added


def outside(text: str, start: int, stop: int, spans: list[tuple[int, int, int]], first: int) -> str:
    """What the sorted spans from number ``first`` on leave of text[start:stop]."""
    rest, at = [], start
    while first < len(spans) and spans[first][0] < stop:
        rest.append(text[at : max(at, spans[first][0])])
        at = max(at, spans[first][2])
        first += 1
    return "".join([*rest, text[at:stop]])


def find_in_text(text: str, novelty: float = 0.8, nearby: int = 48, around: int = 1500) -> list[tuple[int, int, int]]:
    """(start, number of the kind, stop) of each span, sorted; places are code points, the end exclusive."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    spans.sort()
    held = []  # of each candidate: its place, what the base spans leave of it, whether it is in a sensitive context
    covered = 0
    for m in _CANDIDATE.finditer(text):
        start, stop = m.span()
        while covered < len(spans) and spans[covered][2] <= start:
            covered += 1
        assigned = covered < len(spans) and spans[covered][0] < stop and spans[covered][1] < 2
        following = bisect.bisect_left(spans, (stop,))  # a word that begins the next span speaks of that one
        after = min(stop + nearby, spans[following][0]) if following < len(spans) else stop + nearby
        sensitive = assigned or _SENSITIVE.search(text, max(0, start - nearby), start) or _SENSITIVE.search(text, stop, after)
        held.append((start, stop, outside(text, start, stop, spans, covered), bool(sensitive)))
    if not any(c[3] for c in held):
        return spans

    def is_novel(start: int, stop: int, rest: str) -> bool:
        beside = (text[max(0, start - around) : start] + " " + text[stop : stop + around]).replace(text[start:stop], " ")
        return marginal_bytes(rest, beside) >= novelty * len(rest)

    # A secret may go over several candidates: those beside a found one are in its context, to either side.
    found: list[bool | None] = [None] * len(held)
    for way in (1, -1):
        before = None
        for k in range(len(held))[::way]:
            start, stop, rest, sensitive = held[k]
            carried = alike = False
            if before is not None and found[before]:
                first, second = sorted((held[before][:2], (start, stop)))
                carried = _BETWEEN.fullmatch(text, first[1], second[0]) is not None
                alike = carried and first[1] - first[0] == second[1] - second[0]  # lines of one width
            before = k
            if found[k] is not None or not (sensitive or carried):
                continue
            if len(rest) < LEAST:
                found[k] = True  # the base spans have it
            elif alike or _SHAPE.match(rest):
                found[k] = is_novel(start, stop, rest)
    novel = []
    for (start, stop, rest, _), hit in zip(held, found):
        if hit and len(rest) >= LEAST:
            novel.append((start, 3, stop))
        if hit and (tail := _TAIL.match(text, stop)) and tail.end(1) - tail.start(1) < LEAST:
            novel.append((tail.start(1), 3, tail.end(1)))
    return sorted(spans + novel) if novel else spans


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, stop, value) of each row of ``docs`` (doc_id, text, any other columns).

    Spans come by start, then by kind. A null or empty text has none; repeated rows and ids give a row each.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string())]))
        rows = [
            [{"kind": KINDS[k], "start": a, "stop": b, "value": t[a:b]} for a, k, b in find_in_text(t)] for t in batch.column(1).to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    return map_arrow(id_and_text(docs), step, "doc_id long, spans array<struct<kind:string,start:long,stop:long,value:string>>")


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base kinds and all spans as text."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(1).to_pylist():
            spans = find_in_text(text)
            counts = [sum(1 for _, k, _ in spans if k == kind) for kind in range(4)]
            base = written([s for s in spans if s[1] < 3])
            out.append((*counts, hashlib.sha256(base.encode()).hexdigest(), written(spans)))
        n0, n1, n2, n3, sha, text = zip(*out)
        numbers = [pa.array(n, pa.int64()) for n in (n0, n1, n2, n3)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers, pa.array(sha, pa.string()), pa.array(text, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"],
        )

    return map_arrow(
        id_and_text(docs), step, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
    )


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every span, or run of overlapping spans, replaced by the mark."""
    out, at = [], 0
    for start, _, stop in find_in_text(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join([*out, text[at:]]) if at else text


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in the text, and n_chars (if there) counted anew in the rows that change.

    All rows stay. A null text stays null, an empty one empty; repeated rows change alike; columns of any other name
    pass through; an empty table stays empty.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        old = batch.column(names.index("text")).to_pylist()
        new = [None if t is None else redact(t) for t in old]
        if new == old:
            return batch
        columns = list(batch.columns)
        columns[names.index("text")] = pa.array(new, batch.schema.field("text").type)
        if "n_chars" in names:
            k = names.index("n_chars")
            sizes = [n if a == b else len(b) for n, a, b in zip(columns[k].to_pylist(), old, new)]
            columns[k] = pa.array(sizes, batch.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, step, docs.schema)
