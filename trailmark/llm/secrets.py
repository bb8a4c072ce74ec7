"""Secret scans with one combined automaton.

All rules are compiled by subset construction and minimisation into one transition array
(``automaton.compile_rules``), and every text is read once, byte by byte, for all rules together.  The stretches of text
on which the automaton was inside some match and reached an accepting state are the candidates; inside each,
the accepting rules' own expressions settle exact starts and ends, leftmost and without overlap.  A match never
reaches beyond its stretch, so this equals matching the whole text.

The automaton depends on the rules alone (some hundred kilobytes) and is broadcast.

Defined cases: a null text counts as empty; a match never crosses rows, since rows are separated by a byte that takes
the automaton back to its start; repeated rows each get the same spans; an empty table gives no rows.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import astuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from trailmark.llm.automaton import Automaton, compile_rules, run
from trailmark.llm.common import slices, spans_text, text_bytes

# Kinds in their order, the automaton's expression, and the exact one (its first group, if any, is measured).
# The automaton leaves long counts to the exact expression: counters that run side by side multiply its states.
# (kind, automaton's expression, either case, exact expression, least length of the group or the match)
BASE_RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", True,
     rb"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    ("access", r"AKIA[A-Z0-9]+", False, rb"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]{8,}", False, rb"[0-9a-f]+", 32),
]
METHOD_RULES = [
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", False, rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
    ("source_host", r"gh[oprsu]_[A-Za-z0-9]+", False, rb"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}", 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]+", False, rb"xox[abprs]-[A-Za-z0-9-]{10,}", 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", False, rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0),
    ("bearer", r"bearer [A-Za-z0-9._~+/-]+", True, rb"[bB][eE][aA][rR][eE][rR] [A-Za-z0-9._~+/-]{20,}", 0),
    ("url_login", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@", False, rb"://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@", 0),
]
RULES = BASE_RULES + METHOD_RULES
# Where a web token fails, so does every later start before the next dot: the group ``passed`` takes these at once, or a
# long stretch would be read again from each of them.  The matches are those of the rule's expression.
IN_ONE_READING = {
    "web_token": rb"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+|(?P<passed>eyJ[A-Za-z0-9_-]*+)",
}
BETWEEN_ROWS = 10  # a line feed is in no rule


def build() -> Automaton:
    return compile_rules([(rule, fold) for _, rule, fold, _, _ in RULES])


def _candidates(machine: Automaton, states: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches inside a match that reached an accepting state: (begin, end, bits of the accepted rules)."""
    accepted = machine.accepts[states]
    hits = np.flatnonzero(accepted)
    if not len(hits):
        return []
    outside = np.flatnonzero(states == machine.start)
    slots, first = np.unique(np.searchsorted(outside, hits), return_index=True)
    masks = np.bitwise_or.reduceat(accepted[hits], first)
    begins = np.where(slots > 0, outside[slots - 1] + 1, 0) if len(outside) else np.zeros(len(slots), np.int64)
    ends = np.append(outside, len(states))[slots]
    return list(zip(begins.tolist(), ends.tolist(), masks.tolist(), strict=True))


def find_spans(machine: Automaton, raw: np.ndarray, at: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """By row: (rule, start, end) in bytes of the row.  ``at`` has the rows' offsets in ``raw``."""
    rows = len(at) - 1
    # One separator after each row.
    joined = np.full(len(raw) + rows, BETWEEN_ROWS, np.uint8)
    lengths = np.diff(at)
    joined[np.arange(len(raw)) + np.repeat(np.arange(rows), lengths)] = raw
    begins = at[:-1] + np.arange(rows)
    states = run(machine, joined)
    found: dict[int, list[tuple[int, int, int]]] = {}
    exact = [re.compile(IN_ONE_READING.get(rule[0], rule[3])) for rule in RULES]
    for begin, end, mask in _candidates(machine, states):
        row = int(np.searchsorted(begins, begin, "right")) - 1
        piece = joined[begin:end].tobytes()
        for r, (_, _, _, _, least) in enumerate(RULES):
            if not mask >> r & 1:
                continue
            for m in exact[r].finditer(piece):
                if m.lastgroup == "passed":
                    continue
                group = m.lastindex or 0
                if m.end(group) - m.start(group) >= least:
                    shift = begin - int(begins[row])
                    found.setdefault(row, []).append((r, m.start() + shift, m.end() + shift))
    return found


def _scan(machine: Automaton, batches: Iterator[pa.RecordBatch], id_name: str, text: str) -> Iterator[pa.RecordBatch]:
    kinds = [rule[0] for rule in RULES]
    base = {name: i for i, (name, *_) in enumerate(BASE_RULES)}
    for whole in batches:
        for batch in slices(whole, text, 4 << 20):
            raw, at = text_bytes(batch.column(text))
            found = find_spans(machine, raw, at)
            counts = np.zeros((len(base), batch.num_rows), np.int64)
            empty = hashlib.sha256(b"").hexdigest()
            sha, spans = [empty] * batch.num_rows, [""] * batch.num_rows
            for row, hits in found.items():
                own = raw[at[row]:at[row + 1]]
                before = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
                ordered = sorted((int(before[a]), r, int(before[b])) for r, a, b in hits)
                listed = [(kinds[r], a, b) for a, r, b in ordered]
                of_base = [s for s in listed if s[0] in base]
                for kind, _, _ in of_base:
                    counts[base[kind], row] += 1
                sha[row] = hashlib.sha256(spans_text(of_base).encode()).hexdigest()
                spans[row] = spans_text(listed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_name), *[pa.array(c) for c in counts], pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                names=[id_name, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans as text."""
    spark: SparkSession = docs.sparkSession
    # Plain arrays: a broadcast is unpickled without what cloudpickle would carry along.
    machine = spark.sparkContext.broadcast(astuple(build()))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select(doc_id, text).mapInArrow(lambda it: _scan(Automaton(*machine.value), it, doc_id, text), schema)


def op2_query(docs: DataFrame) -> DataFrame:
    return scan_secrets(docs)
