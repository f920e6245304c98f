"""Chat formatting: a hidden Markov model recovers the roles of a transcript's lines, then turns are rendered.

Hidden states are roles. A row's first line, and a line that begins with a speaker marker, may change the
role (transition); other lines go on with it. A line is seen through its marker, length, closing sign,
opening and place (emission). The model is counted on a bounded sample of labelled rows (`SAMPLE`), with
prior counts for markers; the role column is never an input of a prediction.

Viterbi runs over whole conversations of any length: a row is a max-plus matrix (best score from the role
before it to the role at its end), rows of up to `SPAN` turns multiply to a block, blocks to larger blocks,
and the best roles are handed down the same way. So no task holds more than a block of a conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ledgerloom.llm.common import checkpointed, map_texts, thinned

SAMPLE, SPAN_BITS, LEVELS, CROWD = 20_000, 8, 2, 4096
NO_TURN = 1 << 40

# Speaker markers by role.
MARKERS = {
    "system": ("system", "context", "instructions"),
    "user": ("user", "human", "question", "q", "customer", "instruction", "me", "prompt"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "response", "model", "agent"),
}
WHO = {word: role for role, words in MARKERS.items() for word in words}
MARKER = re.compile(r"^\s*(?:<\|(\w+)\|>|\[(\w+)\]|#{2,4}\s*(\w+)\s*:?\s*$|#{2,4}\s*(\w+)\s*:|\*\*(\w+)\s*:?\*\*:?|(\w+)\s*:)\s*", re.IGNORECASE)
#: Prior counts of a marker at its own role and at each other one.
OWN, OTHER = 200.0, 1.0
SIZES = (13, 5, 4, 2, 8)


def marker_of(line: str) -> tuple[str | None, int]:
    """(role, end of the marker) of a line's speaker marker, or (None, 0)."""
    m = MARKER.match(line)
    word = next((g for g in m.groups() if g), "").lower() if m else ""
    return (WHO[word], m.end()) if word in WHO else (None, 0)


def observe(text: str | None) -> list[tuple[str | None, tuple[int, ...]]]:
    """(marker's role, feature values) per line; the features are categories of `SIZES` values."""
    if text is None:
        return []
    lines = text.split("\n")
    out = []
    for i, line in enumerate(lines):
        role, at = marker_of(line)
        bare = line[at:].strip()
        closing = {"?": 1, ".": 2, "!": 3}.get(bare[-1:], 4 if bare else 0)
        opening = 0 if not bare else 1 if bare[0] in "-*>|" else 2 if bare.startswith(("```", "    ")) or bare[0].isdigit() else 3
        out.append((role, (min(len(bare).bit_length(), SIZES[0] - 1), closing, opening, int(i > 0), min(len(lines), SIZES[4] - 1) if i == 0 else 0)))
    return out


@dataclass
class Model:
    """Log probabilities: start and transitions (the last row is the start), markers, and features by role."""

    roles: list[str]
    transition: np.ndarray
    marker: dict[str | None, np.ndarray]
    emission: list[np.ndarray]

    def line(self, role: str | None, values: tuple[int, ...]) -> np.ndarray:
        return self.marker[role] + sum(table[:, v] for table, v in zip(self.emission, values, strict=True))

    def passes(self, seen: list[tuple[str | None, tuple[int, ...]]]) -> np.ndarray:
        """Best score from each role before (or the start) to each role at the end of a row."""
        n = len(self.roles)
        if not seen:
            return self.transition.copy()
        score = self.transition + self.line(*seen[0])
        for role, values in seen[1:]:
            if role is not None:
                moved = (score[:, :, None] + self.transition[None, :n, :]).max(axis=1)
                score = np.maximum(score, moved)
            score = score + self.line(role, values)
        return score

    def inside(self, seen: list[tuple[str | None, tuple[int, ...]]], before: int, last: int) -> list[int]:
        """Roles of a row's lines on the best path from `before` to `last`."""
        if not seen:
            return [last]
        n = len(self.roles)
        score, back = self.transition[before] + self.line(*seen[0]), []
        for role, values in seen[1:]:
            frm = np.arange(n)
            if role is not None:
                moved = score[:, None] + self.transition[:n, :]
                best = moved.argmax(axis=0)
                change = moved[best, frm] > score
                frm = np.where(change, best, frm)
                score = np.maximum(score, moved.max(axis=0))
            back.append(frm)
            score = score + self.line(role, values)
        path = [last]
        for frm in reversed(back):
            path.append(int(frm[path[-1]]))
        return path[::-1]


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Counts over at most `sample` rows of conversations in the order of their hash; null roles are left out.

    All conversations but the last are whole, and there are rows wherever a labelled row exists.
    """
    place = F.xxhash64("conv_id")
    chosen = labelled.where("role is not null and conv_id is not null").select("conv_id", "turn", "role", "text")
    # Conversations in the order of their hash until they hold enough rows; the limit cuts the last one.
    sizes = chosen.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("place", place)
    first = sizes.orderBy("place", "conv_id").limit(sample).collect()
    before = np.cumsum([0] + [r.n for r in first])
    last = max((r.place for r, seen in zip(first, before.tolist(), strict=False) if seen < sample), default=0)
    few = chosen.withColumn("place", place).where(F.col("place") <= last)
    rows = few.orderBy("place", "conv_id", F.col("turn").asc_nulls_last(), F.xxhash64("text")).limit(sample)

    def work(batch: dict[str, list]) -> dict[str, list]:
        seen = [observe(t) for t in batch["text"]]
        return {k: batch[k] for k in ("conv_id", "turn", "role")} | {
            "markers": [[r for r, _ in x] for x in seen],
            "values": [[list(v) for _, v in x] for x in seen],
        }

    found = map_texts(rows, ["conv_id", "turn", "role", "text"], "text", "conv_id long, turn long, role string, markers array<string>, values array<array<int>>", work).collect()
    found.sort(key=lambda r: (r.conv_id, r.turn is None, r.turn or 0))
    roles = sorted({r.role for r in found} | set(MARKERS))
    at, n = {r: i for i, r in enumerate(roles)}, len(roles)
    moves = np.full((n + 1, n), 0.5)
    marks = {k: np.full(n, OTHER) for k in (None, *MARKERS)}
    marks[None] += OWN
    for role in MARKERS:
        marks[role][at[role]] += OWN
    counts = [np.full((n, size), 0.5) for size in SIZES]
    before = None
    for r in found:
        new = before is None or before[0] != r.conv_id
        moves[n if new else before[1], at[r.role]] += 1
        before = (r.conv_id, at[r.role])
        for role, values in zip(r.markers, r["values"], strict=True):
            marks[role][at[r.role]] += 1
            for table, v in zip(counts, values, strict=True):
                table[at[r.role], v] += 1
    all_marks = sum(marks.values())
    return Model(
        roles,
        np.log(moves / moves.sum(axis=1, keepdims=True)),
        {k: np.log(v / all_marks) for k, v in marks.items()},
        [np.log(t / t.sum(axis=1, keepdims=True)) for t in counts],
    )


def multiply(matrices: list[np.ndarray]) -> np.ndarray:
    """Max-plus product of (roles + start) x roles matrices in order."""
    out = matrices[0]
    n = out.shape[1]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None, :n, :]).max(axis=1)
    return out


def best_states(matrices: list[np.ndarray], before: int, last: int | None) -> list[int]:
    """Roles at the end of each matrix on the best path from `before` (roles + 1: the start) to `last` (None: free)."""
    n = matrices[0].shape[1]
    score, back = matrices[0][before], []
    for m in matrices[1:]:
        moved = score[:, None] + m[:n]
        frm = moved.argmax(axis=0)
        back.append(frm)
        score = moved[frm, np.arange(n)]
    path = [int(score.argmax()) if last is None else last]
    for frm in reversed(back):
        path.append(int(frm[path[-1]]))
    return path[::-1]


def _ordered() -> list[Column]:
    """Sort keys of a conversation's rows: turn (nulls behind), then the text's hash."""
    return [F.coalesce("turn", F.lit(NO_TURN)).alias("slot"), F.xxhash64("text").alias("h")]


def decode_roles(rows: DataFrame, model: Model) -> DataFrame:
    """(conv_id, slot, h, before, last): roles around each distinct row, by Viterbi over each conversation.

    A row that repeats conv_id, turn and text is one turn and counts once.
    """
    n = len(model.roles)
    keys = "conv_id long, slot long, h long"

    def weigh(batch: dict[str, list]) -> dict[str, list]:
        scores = [model.passes(observe(t)).ravel() for t in batch["text"]]
        return {k: batch[k] for k in ("conv_id", "slot", "h")} | {"m": scores}

    flat = rows.where("conv_id is not null").select("conv_id", *_ordered(), "text")
    weighed = map_texts(flat, ["conv_id", "slot", "h", "text"], "text", f"{keys}, m array<double>", weigh)
    distinct = weighed.groupBy("conv_id", "slot", "h").agg(F.first("m").alias("m"))
    distinct = checkpointed(distinct.withColumn("b0", F.shiftright("slot", SPAN_BITS)))
    # A block of very many texts at the same turns is cut further, in the same order.
    crowded = distinct.groupBy("conv_id", "b0").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("conv_id", "b0", F.lit(True).alias("many"))
    placed = distinct.join(crowded, ["conv_id", "b0"], "left")
    fine = F.struct(F.when(F.col("many"), F.col("slot")).alias("slot"), F.when(F.col("many"), F.shiftright("h", 54)).alias("top"))
    level = placed.select("conv_id", "b0", fine.alias("sub"), F.struct("slot", "h").alias("item"), "m")

    def grouped(df: DataFrame, by: list[str]) -> DataFrame:
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("item", "m"))).alias("items"))

    def with_product(df: DataFrame) -> DataFrame:
        out = StructType([*df.schema.fields, StructField("m", ArrayType(DoubleType()))])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                products = []
                for items in batch.column("items").to_pylist():
                    products.append(multiply([np.array(x["m"]).reshape(n + 1, n) for x in items]).ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(products, pa.list_(pa.float64()))], [*batch.schema.names, "m"])

        return df.mapInArrow(work, out)

    tree: list[tuple[DataFrame, list[str]]] = []
    by = ["conv_id", "b0", "sub"]
    current = checkpointed(with_product(grouped(level, by)))
    tree.append((current, by))
    up = current.select("conv_id", F.struct("b0", "sub").alias("item"), "b0", "m")
    for k in range(1, LEVELS + 1):
        by = ["conv_id", "b"]
        up = up.withColumn("b", F.shiftright("b0", SPAN_BITS * k) if k < LEVELS else F.lit(0).cast("long"))
        current = checkpointed(with_product(grouped(up, by)))
        tree.append((current, by))
        up = current.select("conv_id", F.struct("b").alias("item"), (F.shiftleft("b", SPAN_BITS * k)).alias("b0"), "m")

    ends = None
    for df, by in reversed(tree):
        top = ends is None
        given = df.withColumns({"before": F.lit(n), "last": F.lit(None).cast("int")}) if top else df.join(ends, by)
        given = given.select("conv_id", "items", "before", "last")
        item = df.schema["items"].dataType.elementType["item"].dataType.simpleString()

        def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: dict[str, list] = {k: [] for k in ("conv_id", "item", "before", "last")}
                for conv, items, before, last in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "items", "before", "last")), strict=True):
                    path = best_states([np.array(x["m"]).reshape(n + 1, n) for x in items], before, last)
                    out["conv_id"] += [conv] * len(items)
                    out["item"] += [x["item"] for x in items]
                    out["before"] += [before, *path[:-1]]
                    out["last"] += path
                kind = batch.schema.field("items").type.value_type.field("item").type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["conv_id"], pa.int64()), pa.array(out["item"], kind), pa.array(out["before"], pa.int32()), pa.array(out["last"], pa.int32())],
                    list(out),
                )

        ends = given.mapInArrow(down, f"conv_id bigint, item {item}, before int, last int").select("conv_id", "item.*", "before", "last")
    return ends


def format_turns(conversations: DataFrame, model: Model | None = None) -> DataFrame:
    """Turns in canonical form: conv_id, turn, part, role, text, rendered.

    A row is one turn as a rule; one that holds several speakers' lines is cut, `part` counts from 0.
    `text` is without its speaker marker; `rendered` is `<|role|>`, the text and `<|end|>` on lines of their
    own, with `<|` inside the text escaped. Without a model one is trained on conversations whose
    crc32(conv_id) modulo 4 is not 2. A null text is an empty turn (text stays null); a row without
    conv_id stands alone; a null turn comes last; rows of one turn are ordered by their text's hash, so ties
    are settled alike in every run; repeated rows all get the role of their turn. Very long texts and
    conversations are decoded whole, in blocks; an empty table gives no rows; other columns are not read.
    """
    model = model or train(conversations.where(F.crc32(F.col("conv_id").cast("string")) % 4 != 2))
    ends = decode_roles(conversations, model)
    start = len(model.roles)
    keyed = conversations.select("conv_id", "turn", *_ordered(), "text")
    joined = keyed.join(ends, ["conv_id", "slot", "h"], "left").select("conv_id", "turn", "text", F.coalesce("before", F.lit(start)).alias("before"), "last")

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        def work(batch: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("conv_id", "turn", "part", "role", "text", "rendered")}
            for conv, turn, text, before, last in zip(*(batch[k] for k in ("conv_id", "turn", "text", "before", "last")), strict=True):
                seen = observe(text)
                end = int(model.passes(seen)[before].argmax()) if last is None else last
                roles = model.inside(seen, before, end)
                lines = text.split("\n") if text is not None else [None]
                parts: list[tuple[int, list]] = []
                for i, (line, role) in enumerate(zip(lines, roles, strict=True)):
                    at = marker_of(line)[1] if line is not None else 0
                    bare = line[at:] if at else line
                    if i == 0 or role != parts[-1][0] or at:
                        parts.append((role, [bare] if bare or not at else []))
                    else:
                        parts[-1][1].append(bare)
                for k, (role, own) in enumerate(parts):
                    content = None if own and own[0] is None else "\n".join(own)
                    name = model.roles[role]
                    shown = (content or "").replace("<|", "<\\|")
                    for key, value in zip(out, (conv, turn, k, name, content, f"<|{name}|>\n{shown}\n<|end|>"), strict=True):
                        out[key].append(value)
            return out

        return work

    schema = "conv_id long, turn long, part int, role string, text string, rendered string"
    return map_texts(joined, ["conv_id", "turn", "text", "before", "last"], "text", schema, work=dict, setup=setup)
