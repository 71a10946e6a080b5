"""Chat formatting by columnar byte assembly.

Turns arrive sorted by conversation. For each Arrow batch the lengths of header, text and trailer of every turn give
cumulative offsets; scatter indices made in numpy copy all three into one preallocated buffer, of which each
conversation is a slice. Control strings inside texts are broken by a backslash after their first character and
backslashes are doubled, so the output can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import prepare

#: (header, trailer) by role; other roles write their name after the fourth's header.
TEMPLATE = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
    "system": ("<<SYS>> ", " <</SYS>>"),
    None: ("[ROLE] ", " [/TURN]"),
}
ROLE_END = " [/ROLE] "
ROLES = ["user", "assistant", "system", None]
ANGLE = r"<(s>|/s>|<SYS>>|</SYS>>)"
SQUARE = r"\[(INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])"
_ANGLE, _SQUARE = re.compile(ANGLE), re.compile(SQUARE)
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|\[ROLE\] (?P<name>.*?) \[/ROLE\] (?P<other>.*?) \[/TURN\]",
    re.DOTALL,
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _SQUARE.sub(r"[\\\1", _ANGLE.sub(r"<\\\1", text))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescape(m["name"]) if kind == "other" else kind
        out.append((role, unescape(m[kind])))
        at = m.end()
    return out


def _escaped(texts: pa.Array) -> pa.Array:
    odd = pc.match_substring_regex(texts, r"\\|" + ANGLE + "|" + SQUARE)
    if not pc.any(odd).as_py():
        return texts
    return pa.array([escape(t) if o else t for t, o in zip(texts.to_pylist(), odd.to_pylist(), strict=True)], pa.large_string())


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return o, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def assemble(roles: list[str], texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer, each turn's offset in it (and the end), and each escaped text's offset and length, in bytes."""
    code = np.array([ROLES.index(r) if r in TEMPLATE and r is not None else 3 for r in roles], dtype=np.int64)
    heads = [TEMPLATE[r][0].encode() for r in ROLES[:3]]
    tails = [TEMPLATE[r][1].encode() for r in ROLES]
    own = {r: (TEMPLATE[None][0] + escape(r) + ROLE_END).encode() for r in {r for r, c in zip(roles, code, strict=True) if c == 3}}
    names = list(own)
    which = np.array([names.index(r) + 3 if c == 3 else c for r, c in zip(roles, code, strict=True)], dtype=np.int64)
    heads += own.values()
    head_len, tail_len = np.array([len(h) for h in heads]), np.array([len(t) for t in tails])
    head_at, tail_at = np.cumsum(head_len) - head_len, np.cumsum(tail_len) - tail_len
    head_data, tail_data = np.frombuffer(b"".join(heads), np.uint8), np.frombuffer(b"".join(tails), np.uint8)
    offsets, data = _buffers(_escaped(texts))
    size = np.diff(offsets)
    h, t = head_len[which], tail_len[code]
    turn = np.zeros(len(roles) + 1, dtype=np.int64)
    np.cumsum(h + size + t, out=turn[1:])
    out = np.empty(int(turn[-1]), dtype=np.uint8)
    out[_ranges(turn[:-1], h)] = head_data[_ranges(head_at[which], h)]
    out[_ranges(turn[:-1] + h, size)] = data[offsets[0] : offsets[-1]]
    out[_ranges(turn[1:] - t, t)] = tail_data[_ranges(tail_at[code], t)]
    return out, turn, turn[:-1] + h, size


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, role, text) in order; a conversation may span batches."""

    def emit(ids, bodies, spans, turns):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(bodies, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(turns, pa.int64()),
            ],
            ["conv_id", "formatted", "loss_spans", "n_turns"],
        )

    open_id, parts, spans, chars, turns, begun = None, [], [], 0, 0, False
    for b in batches:
        if not b.num_rows:
            continue
        ids, roles = b.column(0).to_pylist(), b.column(1).to_pylist()
        out, turn, text_at, size = assemble(roles, b.column(2))
        points = np.zeros(len(out) + 1, dtype=np.int64)
        np.cumsum((out & 0xC0) != 0x80, out=points[1:])
        done = ([], [], [], [])
        cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if begun and ids[a] != open_id:
                for column, x in zip(done, (open_id, b"".join(parts).decode(), spans, turns), strict=True):
                    column.append(x)
                parts, spans, chars, turns = [], [], 0, 0
            open_id, begun = ids[a], True
            base = chars - points[turn[a]]
            for i in range(a, z):
                if roles[i] == "assistant":
                    p = points[text_at[i]]
                    spans.append({"start": int(p + base), "length": int(points[text_at[i] + size[i]] - p)})
            parts.append(out[turn[a] : turn[z]].tobytes())
            chars += int(points[turn[z]] - points[turn[a]])
            turns += z - a
        if done[0]:
            yield emit(*done)
    if begun:
        yield emit([open_id], [b"".join(parts).decode()], [spans], [turns])


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: id_col, formatted, loss_spans (start and length in code points of each assistant text, as
    escaped), n_turns.

    Turns go by turn, role and text, nulls first; null role and text are empty strings. Rows without a conversation
    form one of their own. Repeated rows are turns each. An empty table gives an empty result. One task streams a
    conversation and holds no more than that conversation and a batch, since its output is one value.
    """
    prepare(conversations.sparkSession)
    slim = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.col(f"`{turn_col}`").alias("turn"),
    )
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    out = ordered.mapInArrow(
        _format, "conv_id long, formatted string, loss_spans array<struct<start:long,length:long>>, n_turns long"
    )
    return out.withColumnRenamed("conv_id", id_col)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for body, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            turns = parse(body)
            loss = "".join(unescape(body[s["start"] : s["start"] + s["length"]]) for s in spans)
            rows.append(
                (
                    len(turns),
                    hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(),
                    len(body),
                )
            )
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *columns], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        )


PROBE = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    return format_chats(rows.unionByName(probe)).mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *,
    length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(s>|/s>|<SYS>>|</SYS>>)', '<\\\1', 'g'),
                          '\[(INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])', '[\\\1', 'g')) AS text_chars,
    length(regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(s>|/s>|<SYS>>|</SYS>>)', '<\\\1', 'g'),
                          '\[(INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])', '[\\\1', 'g')) AS role_chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
                             ELSE 24 + role_chars END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
