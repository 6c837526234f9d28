"""Chat formatting of reply trees.

Iterative self-joins by doubling give each message its root, its depth and the score of its path (round k knows the
ancestor 2**k above), so a path of L messages takes log2 L rounds. The leaves of a root are ranked by mean score; the
chosen leaf marks its ancestors by the same jumps, from the longest to the shortest. Each chosen path is one conversation.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import per_partition, prepare, save

# The template: a turn is "<turn ROLE>\nTEXT</turn>\n". Roles and texts escape backslash and both angle brackets with a
# backslash, roles also line ends; so no text holds a control string and unescape() gives back what was there.
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^<>\\\n]|\\.)*)>\n((?:[^<>\\]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def unescape_role(role: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[int]]:
    """The formatted conversation, and its loss mask as starts and ends (code points) of the texts of role learn."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn {escape_role(role)}>\n", escape(text)
        if role == learn:
            mask += [at + len(head), at + len(head) + len(body)]
        parts += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(parts), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(formatted):
        if (m := _TURN.match(formatted, at)) is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def paths(messages: DataFrame) -> DataFrame:
    """The best root-to-leaf path of each tree, as (root, depth, id).

    messages: id, parent (null: root; one not among the ids: root too), score double (null: 0). Leaves are ranked by the
    mean score of their path, then length (longer first), then id. Ids must be unique; messages that lie on a cycle or
    below one have no root and appear in no path. No rows give no rows."""
    m = messages.select("id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = m.select(F.col("id").alias("p"))
    m = m.join(known, F.col("parent") == F.col("p"), "left").select("id", F.col("p").alias("up"), "score")
    state = save(m.select("id", "up", F.when(F.col("up").isNull(), F.col("id")).alias("root"), F.lit(1).cast("long").alias("n"), "score"), "jump0")
    # Only messages that don't know their root yet are joined on; jumps[k] has those with an ancestor 2**k above.
    done, active, jumps, before = state.where("root is not null"), state.where("root is null"), [], None
    while (left := active.count()) not in (0, before):  # those on or below a cycle never get a root
        jumps.append(active)
        above = done.unionByName(active).select(F.col("id").alias("a_id"), F.col("up").alias("a_up"), F.col("root").alias("a_root"), F.col("n").alias("a_n"), F.col("score").alias("a_score"))
        on = active.join(above, F.col("up") == F.col("a_id"))
        moved = save(on.select("id", F.col("a_up").alias("up"), F.col("a_root").alias("root"), (F.col("n") + F.col("a_n")).alias("n"), (F.col("score") + F.col("a_score")).alias("score")), f"jump{len(jumps)}")
        done, active, before = done.unionByName(moved.where("root is not null")), moved.where("root is null"), left
    parents = state.where("up is not null").select(F.col("up").alias("p")).distinct()
    leaves = done.join(parents, F.col("id") == F.col("p"), "left_anti")
    best = leaves.groupBy("root").agg(F.max_by(F.struct("id", "n"), F.struct((F.col("score") / F.col("n")).alias("s"), "n", (-F.col("id")).alias("i"))).alias("b"))
    marked = save(best.select("root", (F.col("b.n") - 1).alias("depth"), F.col("b.id").alias("id")), "marked")
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("id").alias("j"), "up")
        more = marked.join(jump, F.col("id") == F.col("j")).select("root", (F.col("depth") - (1 << k)).alias("depth"), F.col("up").alias("id"))
        marked = save(marked.unionByName(more), f"marked{k}")
    return marked


def chains(conversations: DataFrame) -> DataFrame:
    """Flat conversations as reply trees: each row answers the one before it by turn. Adds id, parent and score."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    numbered = save(conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.monotonically_increasing_id()), "messages")
    w = Window.partitionBy("conv_id").orderBy(*order, "id")
    return numbered.select("conv_id", "id", F.lag("id").over(w).alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def format_trees(messages: DataFrame, template_role: str = "assistant") -> DataFrame:
    """messages: conv_id, id, parent, score, role, text. A row for each tree: conv_id, formatted, mask (starts and ends of loss).

    Null roles and texts count as empty. A null conv_id is a conversation of its own. No rows give no rows."""
    prepare(messages.sparkSession)
    on = paths(messages.select("id", "parent", "score")).withColumnRenamed("id", "m_id")
    rows = messages.join(on, F.col("id") == F.col("m_id")).select("root", "depth", "conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition(per_partition(messages), "root").sortWithinPartitions("root", "depth")

    def build(batches):
        at, conv, turns = None, None, []

        def out():
            text, mask = format_turns(turns, template_role)
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([text], pa.string()), pa.array([mask], pa.list_(pa.int64()))], names=["conv_id", "formatted", "mask"])

        for b in batches:
            for root, c, role, text in zip(*(b[k].to_pylist() for k in ("root", "conv_id", "role", "text")), strict=True):
                if root != at:
                    if turns:
                        yield out()
                    at, conv, turns = root, c, []
                turns.append((role, text))
        if turns:
            yield out()

    return ordered.mapInArrow(build, "conv_id long, formatted string, mask array<long>")


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest of formatted conversations, from their text and mask alone."""

    def digest(batches):
        for b in batches:
            rows = []
            for conv, text, mask in zip(b["conv_id"].to_pylist(), b["formatted"].to_pylist(), b["mask"].to_pylist(), strict=True):
                turns, whole = parse_turns(text), hashlib.sha256()
                for role, t in turns:
                    whole.update(f"{role}\n{t}\n".encode())
                loss = "".join(unescape(text[s:e]) for s, e in zip(mask[::2], mask[1::2], strict=True))
                rows.append((conv, len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The conversation that the contract adds.
PROBE = "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    spark: SparkSession = conversations.sparkSession
    extra = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)


ORACLE = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (select *, replace(replace(replace(text, '\', '\\'), '<', '\<'), '>', '\>') as x from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(role) + length(x) + 16)::bigint as formatted_chars
from e group by conv_id
"""
