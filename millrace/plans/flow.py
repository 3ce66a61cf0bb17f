"""Dependencies and order A19-A21.

Records that share a topic form a bipartite graph: sinks read topics, sources write them. The graph is kept with the
topic as a node. Its size is the number of (record, topic) links; writing out every sink-source pair of a busy topic
would be quadratic, and nothing here needs that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace import session
from millrace.functions import text
from millrace.operators import skew


def flow_nodes(heads: DataFrame) -> DataFrame:
    """(record_id, name, class, topics) of every record, checkpointed.

    The results below read it several times, and it is far smaller than the documents it comes from.
    """
    session.shared_folder(heads.sparkSession)
    return heads.select("record_id", "name", "class", "topics").checkpoint()


def topic_links(nodes: DataFrame) -> DataFrame:
    """(record_id, name, topic, kind) of sources and sinks, once per record and topic."""
    return (
        nodes.select("record_id", "name", text.kind(F.col("class")).alias("kind"),
                     F.explode(F.array_distinct("topics")).alias("topic"))
        .where(F.col("kind") != "unknown")
    )


def _topic_ends(links: DataFrame) -> DataFrame:
    """Per topic: whether a dependency runs through it, that is a sink and a source of different names."""
    return (
        links.groupBy("topic").agg(
            F.bool_or(F.col("kind") == "sink").alias("read"), F.bool_or(F.col("kind") == "source").alias("written"),
            F.min("name").alias("low"), F.max("name").alias("high"))
        .select("topic", (F.col("read") & F.col("written") & (F.col("low") != F.col("high"))).alias("linked"))
    )


def dependency_edges(heads: DataFrame) -> DataFrame:
    """Edges (from_node, to_node, topic) sink -> topic -> source, for topics that have both ends.

    A sink depends on a source exactly when a path of two edges joins them and their names differ.
    """
    links = topic_links(flow_nodes(heads))
    used = skew.salted_join(links, _topic_ends(links).where("linked").select("topic"), ["topic"], "left_semi")
    node = F.concat(F.lit("topic:"), F.col("topic"))
    sink = F.col("kind") == "sink"
    return used.select(F.when(sink, F.col("record_id")).otherwise(node).alias("from_node"),
                       F.when(sink, node).otherwise(F.col("record_id")).alias("to_node"), "topic")


def dependencies_of(heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """A19 for chosen records (``record_id``): (record_id, depends_on), each source name once.

    The result has one row per chosen sink and source it reads from, which is what the caller asked to see.
    """
    links = topic_links(flow_nodes(heads))
    sinks = links.where("kind = 'sink'").join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    sources = links.where("kind = 'source'").select("topic", F.col("name").alias("depends_on"))
    return (
        skew.salted_join(sinks, sources, ["topic"], "inner")
        .where(F.col("name") != F.col("depends_on")).select("record_id", "depends_on").distinct()
    )


def dependency_counts(links: DataFrame) -> DataFrame:
    """(record_id, dependencies) of sinks: how many sources write the topics it reads, counted per topic.

    Sources are counted per topic first, so the join carries one number instead of the sources.
    """
    sinks, sources = links.where("kind = 'sink'"), links.where("kind = 'source'")
    per_topic = sources.groupBy("topic").agg(F.count(F.lit(1)).alias("writers"))
    namesakes = sources.groupBy("topic", "name").agg(F.count(F.lit(1)).alias("own"))
    counted = skew.salted_join(sinks, per_topic, ["topic"], "inner")
    # Many records may share a name, so this join spreads hot keys too.
    named = skew.salted_join(counted, namesakes, ["topic", "name"], "left")
    others = F.col("writers") - F.coalesce("own", F.lit(0))
    return named.groupBy("record_id").agg(F.sum(others).alias("dependencies"))


ORDER = ("priority", "dependencies", "name", "record_id")


def prioritised(nodes: DataFrame) -> DataFrame:
    """Add ``priority`` (source 1, else change capture 0, else sink 2, else 3) and ``dependencies``."""
    name = F.lower("class")
    priority = (
        F.when(F.contains(name, F.lit("source")), 1).when(F.contains(name, F.lit("debezium")), 0)
        .when(F.contains(name, F.lit("sink")), 2).otherwise(3)
    )
    return (
        nodes.join(dependency_counts(topic_links(nodes)), "record_id", "left").na.fill(0, ["dependencies"])
        .withColumn("priority", priority)
    )


def order_plan(heads: DataFrame) -> DataFrame:
    """Records in order of priority, dependencies, name; ``rank`` counts from 1 over all records."""
    plan = prioritised(flow_nodes(heads)).select("record_id", "name", "priority", "dependencies")
    numbered = skew.dense_index(plan, ORDER)
    return numbered.withColumn("rank", F.col("_index") + 1).drop("_index")


def shared_flow(heads: DataFrame) -> DataFrame:
    """One row, true when any dependency exists or a record shares a topic with the first of the plan."""
    nodes = flow_nodes(heads)
    linked = _topic_ends(topic_links(nodes)).agg(F.coalesce(F.bool_or("linked"), F.lit(False))).scalar()
    first = prioritised(nodes).agg(F.min_by(F.struct("record_id", "topics"), F.struct(*ORDER))).scalar()
    shares = nodes.where((F.col("record_id") != first["record_id"]) & F.arrays_overlap("topics", first["topics"]))
    return shares.agg((linked | (F.count(F.lit(1)) > 0)).alias("combined"))
