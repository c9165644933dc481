"""Content identities: SHA-256 of the JSON of an ordered tuple, nulls kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGENT = ("agent_database", "agent_schema", "agent_name")
#: What an event is, in the order of its identity.
EVENT_FIELDS = (
    *AGENT, "event_epoch_ns", "trace_id", "span_id", "span_name", "span_type", "thread_id", "message_id",
    "user_question", "agent_answer", "tool_name", "executed_sql", "chart_definition", "status_code",
)
NO_ITEMS = "4f53cda18c2baa0c0354bb5f9a3ecbe5ed12ab4d8e11ba873c2f11161202b945"  #: of an empty list


def identity(*parts: str | Column) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(cols))), {"ignoreNullFields": "false"}), 256)


def list_identity(items: Column) -> Column:
    """Of an array in its order; NO_ITEMS for an empty one."""
    return F.sha2(F.to_json(items), 256)


PREFIX = 4  #: hexadecimal digits of a member's hash that name its leaf: a group has 65,536 leaves at most


def _leaf(item: str) -> Column:
    return F.substr(item, F.lit(1), F.lit(PREFIX)).alias("leaf")


def leaf_digests(members: DataFrame, by: list[str], item: str) -> DataFrame:
    """(by, leaf, n, digest) of groups of members by hashes in `item`: the first level of a Merkle tree of fixed shape.

    A leaf holds the members whose hash begins with it; its digest is the SHA-256 of their sorted hashes, joined by commas.
    A leaf of a group of ten thousand million members has some 150,000, so no task holds a group. Nulls are no members;
    repeated members count each; by: columns without nulls.
    """
    rows = members.where(F.col(item).isNotNull()).select(*by, _leaf(item), item)
    sorted_ = F.expr(f"listagg(`{item}`, ',') within group (order by `{item}`)")
    return rows.groupBy(*by, "leaf").agg(F.count("*").alias("n"), F.sha2(sorted_, 256).alias("digest"))


def updated_leaves(leaves: DataFrame, saved: DataFrame, new: DataFrame, by: list[str], item: str) -> DataFrame:
    """leaf_digests of saved and new members together, from those of the saved ones: only leaves that a new member falls into
    are hashed again, from the saved members of these leaves; saved groups that get none are not read."""
    leaf = _leaf(item)
    touched = new.where(F.col(item).isNotNull()).select(*by, leaf).distinct()
    of_touched = saved.select(*by, item, leaf).join(touched, [*by, "leaf"], "left_semi").select(*by, item)
    again = leaf_digests(of_touched.unionByName(new.select(*by, item)), by, item)
    return leaves.join(touched, [*by, "leaf"], "left_anti").unionByName(again)


def root_digests(leaves: DataFrame, by: list[str]) -> DataFrame:
    """(by, digest, n) of groups from their leaves: the SHA-256 of `leaf:digest` of all leaves in order, joined by commas."""
    sorted_ = F.expr("listagg(concat(leaf, ':', digest), ',') within group (order by leaf)")
    return leaves.groupBy(*by).agg(F.sha2(sorted_, 256).alias("digest"), F.sum("n").alias("n"))


def members_digest(members: DataFrame, by: list[str], item: str) -> DataFrame:
    """(by, digest, n) of each group: the identity of all its members in any order."""
    return root_digests(leaf_digests(members, by, item), by)
