"""Chat formatting (operator 12): conversations as training text with a loss mask, by columnar byte assembly.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside roles and texts are
escaped: a match is a control string with any number of backslashes after its first character, and gets
one more; unescaping takes one away from matches that have any. No control string overlaps another
(checked by ``Template``), so matches never overlap, the way back is exact, and an escaped text holds no
control string, alone or together with the marks around it.

Assembly works on the columns of many turns at once. The markers, the batch's roles and its texts lie in
one source buffer; each turn is a row of segments (start in the source, length), the insertion of a
backslash cuts a segment in two. Cumulated lengths give each segment's place in the output, and the
bytes are copied by gather indices into one preallocated Arrow buffer, ``COPY`` bytes at a time, whose
offsets are the conversations' bounds.

``formatted`` has one row per conversation: ``conv_id, part`` (0), ``n_turns, formatted, loss_starts,
loss_ends`` (code points, one pair per turn of a role in ``trained``). Turns are ordered by ``turn`` (nulls
first), ties by role, then by the text's ``xxhash64``. A conversation of more than ``LONG_BYTES`` is dealt by ranges of that order over
many tasks and comes in several rows, whose ``part`` (1 or more, with gaps) gives their order; no task or
row holds a whole one. Joining the parts gives what one row would hold, mask positions count from the part's
begin.

Rows: null texts and roles are empty; a null ``conv_id`` is a conversation of its own; repeated rows are
turns of their own; other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import mapped, stored, text_bytes

#: Bytes of a conversation beyond which it is written in parts, of a part, and of one copy step.
LONG_BYTES, PART_BYTES, COPY = 8 << 20, 4 << 20, 1 << 20
#: What a turn counts besides its text.
TURN_BYTES = 64

# Control strings of common chat formats that texts must not smuggle in.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


@dataclass(frozen=True)
class Template:
    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    controls: tuple[str, ...] = CONTROLS
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for a in self.controls:
            if len(a) < 2 or "\\" in a or not a.isascii():
                raise ValueError(f"control string {a!r}: ASCII of two or more characters without backslash")
            for b in self.controls:
                shift = range(1 if a == b else 0, len(a))
                if any(b.startswith(a[i : i + len(b)]) for i in shift):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        if not {self.begin, self.middle, self.end} <= set(self.controls):
            raise ValueError("the template's own marks must be control strings")

    def pattern(self) -> str:
        """Groups: first character, backslashes, rest. The same in Python, Java and RE2."""
        by_first: dict[str, list[str]] = {}
        for c in self.controls:
            by_first.setdefault(c[0], []).append(re.sub(r"([^A-Za-z0-9_<>/])", r"\\\1", c[1:]))
        first = "".join("\\" + c for c in sorted(by_first))
        return rf"([{first}])(\\*)({'|'.join(r for c in sorted(by_first) for r in by_first[c])})"

    def escape(self, text: str) -> str:
        return re.sub(self.pattern(), r"\1\\\2\3", text)

    def unescape(self, text: str) -> str:
        return re.sub(self.pattern(), lambda m: m[1] + m[2][1:] + m[3], text)


def _insertions(template: Template, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where in ``data`` (texts in a row) a backslash goes; matches across a text's bounds are none."""
    spans = np.array([(m.start(), m.end()) for m in re.finditer(template.pattern().encode(), memoryview(data))], dtype=np.int64).reshape(-1, 2)
    inside = np.searchsorted(bounds, spans[:, 0], side="right") == np.searchsorted(bounds, spans[:, 1] - 1, side="right")
    return spans[inside, 0] + 1


def _cut(bounds: np.ndarray, cuts: np.ndarray, slash: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (owner, start, length) of texts with ``bounds`` that lie at ``base`` in the source and get a backslash at ``cuts``."""
    owner = np.searchsorted(bounds, cuts, side="right") - 1
    n = len(bounds) - 1
    begins = np.concatenate((bounds[:-1], cuts))
    whose = np.concatenate((np.arange(n), owner))
    order = np.lexsort((np.concatenate((np.zeros(n, dtype=np.int8), np.ones(len(cuts), dtype=np.int8))), begins, whose))
    begins, whose = begins[order], whose[order]
    last = np.append(whose[1:] != whose[:-1], True) if len(whose) else np.zeros(0, dtype=bool)
    ends = np.where(last, bounds[1:][whose], np.append(begins[1:], 0)[: len(begins)])
    pieces = np.stack((begins + base, np.full(len(begins), slash)), axis=1).ravel()
    lengths = np.stack((ends - begins, (~last).astype(np.int64)), axis=1).ravel()
    return np.repeat(whose, 2), pieces, lengths


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 ``data`` that begin before each byte position of ``at``."""
    known, back = np.unique(at, return_inverse=True)
    counts, before = np.zeros(len(known), dtype=np.int64), 0
    for lo in range(0, len(data), COPY):
        seen = np.cumsum((data[lo : lo + COPY] & 0xC0) != 0x80)
        s, e = np.searchsorted(known, (lo + 1, lo + len(seen) + 1))
        counts[s:e] = before + seen[known[s:e] - lo - 1]
        before += int(seen[-1])
    return counts[back].reshape(at.shape)


def assemble(template: Template, roles: pa.Array, texts: pa.Array, groups: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The formatted text of each group of turns (bounds ``groups``), and per turn the code points in its group
    before its content begins and ends."""
    marks = "".join((template.begin, template.middle, template.end, "\\")).encode()
    a, b, c = len(template.begin), len(template.middle), len(template.end)
    role_data, role_bounds = text_bytes(roles)
    text_data, text_at = text_bytes(texts)
    source = np.concatenate((np.frombuffer(marks, dtype=np.uint8), role_data, text_data))
    n, slash = len(texts), len(marks) - 1
    turns = np.arange(n)
    who, begins, lengths, rank = [], [], [], []

    def add(owner, start, length, place):
        who.append(owner), begins.append(start), lengths.append(length), rank.append(np.full(len(owner), place, dtype=np.int8))

    add(turns, np.zeros(n, dtype=np.int64), np.full(n, a), 0)
    add(*_cut(role_bounds, _insertions(template, role_data, role_bounds), slash, len(marks)), 1)
    add(turns, np.full(n, a), np.full(n, b), 2)
    add(*_cut(text_at, _insertions(template, text_data, text_at), slash, len(marks) + len(role_data)), 3)
    add(turns, np.full(n, a + b), np.full(n, c), 4)
    whose, start, length, place = (np.concatenate(x) for x in (who, begins, lengths, rank))
    order = np.lexsort((place, whose))  # stable, so segments of one text stay in order
    whose, start, length, place = whose[order], start[order], length[order], place[order]
    ends = np.cumsum(length)
    total = int(ends[-1]) if n else 0
    at = ends - length

    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, dtype=np.uint8)
    for lo in range(0, total, COPY):
        hi = min(lo + COPY, total)
        s, e = np.searchsorted(ends, lo, side="right"), np.searchsorted(at, hi, side="left")
        first = np.maximum(at[s:e], lo)
        size = np.minimum(ends[s:e], hi) - first
        out[lo:hi] = source[np.repeat(start[s:e] + first - at[s:e] - (first - lo), size) + np.arange(hi - lo)]

    turn_first = np.searchsorted(whose, np.append(turns, n))
    turn_end = np.append(0, ends)[turn_first]
    offsets = turn_end[groups].astype(np.int64)
    content = np.searchsorted(whose * 8 + place, np.stack((turns * 8 + 3, turns * 8 + 4)))
    content = np.append(0, ends)[content]
    home = offsets[np.searchsorted(groups, turns, side="right") - 1]
    spans = _points(out, content) - _points(out, home)
    formatted = pa.Array.from_buffers(pa.large_string(), len(groups) - 1, [None, pa.py_buffer(offsets.tobytes()), buffer])
    return formatted, spans[0], spans[1]


_SCHEMA = "part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def _rows(template: Template, turns: pa.Table, groups: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    roles, texts = (pc.fill_null(turns.column(c).cast(pa.large_string()), "").combine_chunks() for c in ("role", "text"))
    formatted, starts, ends = assemble(template, roles, texts, groups)
    trained = np.flatnonzero(pc.is_in(roles, pa.array(template.trained, pa.large_string())).to_numpy(zero_copy_only=False))
    at = pa.array(np.searchsorted(trained, groups), pa.int32())
    masks = [pa.ListArray.from_arrays(at, pa.array(x[trained])) for x in (starts, ends)]
    ids = turns.column("conv_id").combine_chunks().take(pa.array(groups[:-1]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(parts, pa.int64()), pa.array(np.diff(groups), pa.int64()), formatted.cast(pa.string()), *masks], names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"]
    )


def _sized(turns: pa.Table) -> np.ndarray:
    """Bytes up to and including each turn."""
    return np.cumsum(sum(np.nan_to_num(pc.binary_length(turns.column(c)).to_numpy()).astype(np.int64) for c in ("role", "text")) + TURN_BYTES)


def _group_bounds(turns: pa.Table) -> np.ndarray:
    ids = turns.column("conv_id").combine_chunks()
    same = pc.equal(ids[1:], ids[:-1])
    null = ids.is_null()
    both = pc.and_(null[1:], null[:-1])
    cuts = np.flatnonzero(~pc.or_(pc.fill_null(same, False), both).to_numpy(zero_copy_only=False)) + 1
    return np.concatenate(([0], cuts, [len(ids)])).astype(np.int64)


def _formatter(template: Template, in_parts: bool):
    """Sorted turns to rows of conversations; ``in_parts``: to rows of about ``PART_BYTES`` within conversations."""

    def emit(turns: pa.Table, groups: np.ndarray, number: int) -> Iterator[pa.RecordBatch]:
        sizes = np.append(0, _sized(turns))
        at = 0
        while at < len(groups) - 1:  # conversations of about PART_BYTES together are one assembly
            to = max(at + 1, int(np.searchsorted(sizes[groups], sizes[groups[at]] + PART_BYTES, side="right")) - 1)
            lo, hi = groups[at], groups[to]
            parts = number + np.arange(at, to) if in_parts else np.zeros(to - at, dtype=np.int64)
            yield _rows(template, turns.slice(lo, hi - lo), groups[at : to + 1] - lo, parts)
            at = to

    def split(turns: pa.Table, groups: np.ndarray) -> np.ndarray:
        """``groups`` with further bounds so that none but a single turn exceeds ``PART_BYTES``."""
        sizes, out = np.append(0, _sized(turns)), []
        for s, e in zip(groups[:-1], groups[1:]):
            while s < e:
                out.append(s)
                s = max(s + 1, min(e, int(np.searchsorted(sizes, sizes[s] + PART_BYTES, side="right")) - 1))
        return np.array([*out, groups[-1]], dtype=np.int64)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = (TaskContext.get().partitionId() << 33) + 1 if in_parts else 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            turns = pa.Table.from_batches(held)
            groups = _group_bounds(turns)
            groups = split(turns, groups) if in_parts else groups
            yield from emit(turns, groups[:-1], number)
            number += len(groups) - 2
            held = turns.slice(groups[-2]).combine_chunks().to_batches()
        if held:
            turns = pa.Table.from_batches(held)
            yield from emit(turns, np.array([0, len(turns)], dtype=np.int64), number)

    return step


def formatted(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss_starts, loss_ends`` for ``turns(conv_id, turn, role, text)``."""
    turns = turns.select("conv_id", "turn", "role", "text")
    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {_SCHEMA}"
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("role"), F.lit(0)) + TURN_BYTES
    sizes = turns.select("conv_id", size.cast("long").alias("size")).groupBy("conv_id").agg(F.sum("size").alias("size"))
    long = stored(sizes.where(F.col("size") > LONG_BYTES).select(F.col("conv_id").alias("long_id"), F.lit(True).alias("is_long")), "long_conversations")
    turns = turns.withColumn("hash", F.xxhash64("text"))
    order = ["conv_id", "turn", "role", "hash"]
    whole, cut = turns, None
    if long.limit(1).count():
        marked = turns.join(long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left")
        whole = marked.where("is_long is null").select(*turns.columns)
        cut = marked.where("is_long").select(*turns.columns, F.monotonically_increasing_id().alias("row"))  # deals equal rows too
        cut = mapped(cut.repartitionByRange(*order, "row").sortWithinPartitions(*order, "text"), _formatter(template, True), schema)
    whole = mapped(whole.repartition("conv_id").sortWithinPartitions(*order, "text"), _formatter(template, False), schema)
    return whole if cut is None else whole.unionByName(cut)


def turns_of(template: Template, text: str) -> Iterator[tuple[str, str]]:
    """The roles and contents of one formatted text, unescaped."""
    turn = re.compile(f"{re.escape(template.begin)}(.*?){re.escape(template.middle)}(.*?){re.escape(template.end)}", re.S)
    at = 0
    for m in turn.finditer(text):
        if m.start() != at:
            raise ValueError("not a formatted text")
        yield template.unescape(m[1]), template.unescape(m[2])
        at = m.end()
    if at != len(text):
        raise ValueError("not a formatted text")


def _reader(template: Template):
    """One digest row per conversation; a conversation's parts come in a row and in order, one is held at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now = None

        def done():
            out.append((now["id"], now["turns"], now["all"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["formatted"]))

        for batch in batches:
            for conv_id, part, text, starts, ends in zip(*(batch.column(c) for c in ("conv_id", "part", "formatted", "loss_starts", "loss_ends"))):
                conv_id, text = conv_id.as_py(), text.as_py()
                if now is None or not part.as_py() or not now["part"] or now["id"] != conv_id:
                    if now is not None:
                        done()
                    now = {"id": conv_id, "part": part.as_py(), "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "formatted": 0}
                for role, content in turns_of(template, text):
                    now["all"].update(f"{role}\n{content}\n".encode())
                    now["turns"] += 1
                for s, e in zip(starts.as_py(), ends.as_py()):
                    content = template.unescape(text[s:e])
                    now["loss"].update(content.encode())
                    now["chars"] += len(content)
                now["formatted"] += len(text)
            if out:
                yield _digests(out, batch.schema.field("conv_id").type)
                out = []
            last_type = batch.schema.field("conv_id").type
        if now is not None:
            done()
            yield _digests(out, last_type)

    return read


def _digests(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def digests(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """What the rows of ``formatted`` say, read back from text and mask: ``conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``. A digest runs over a conversation's bytes in order, so the
    parts of a long one pass through one task, one at a time."""
    kept = rows.select("conv_id", "part", "formatted", "loss_starts", "loss_ends")
    in_order = kept.where("part > 0").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    whole = mapped(kept.where("part = 0"), _reader(template), schema)
    return whole.unionByName(mapped(in_order, _reader(template), schema))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(stored(formatted(turns.unionByName(extra)), "formatted"))


_ESCAPED = "regexp_replace({}, '" + Template().pattern() + "', '\\1\\\\\\2\\3', 'g')"
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum({len(Template().begin + Template().middle + Template().end)} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""
