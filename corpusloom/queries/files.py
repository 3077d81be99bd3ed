"""Queries that write files with the sinks and read them back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.queries.registry import Tables, query
from corpusloom.session import shared_dir
from corpusloom.sinks import tables as sinks


def _folder(t: Tables, name: str) -> str:
    return os.path.join(shared_dir(t.spark), f"{name}-{uuid.uuid4().hex}")


@query(
    "q_partition_rewrite",
    """
    select o_orderpriority as venue, o_orderkey, o_totalprice from orders
    where o_orderpriority like '3%' or (o_orderstatus = 'F' and o_orderpriority not like '1%')
    """,
)
def partition_rewrite(t: Tables) -> DataFrame:
    """Orders per priority; a second run answers for all but one of them, and has nothing for another."""
    path = _folder(t, "orders")
    rows = t.orders.select(F.col("o_orderpriority").alias("venue"), "o_orderkey", "o_totalprice")
    finished = t.orders.where("o_orderstatus = 'F' and o_orderpriority not like '1%' and o_orderpriority not like '3%'")
    again = finished.select(F.col("o_orderpriority").alias("venue"), "o_orderkey", "o_totalprice")
    sinks.write_partitions(rows, path)
    sinks.write_partitions(again, path, covered=rows.where("venue not like '3%'").select("venue"))
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "q_partition_manifest",
    """
    select source as venue, count(*) filter (where lang = 'en') as n_rows from documents group by source
    """,
)
def partition_manifest(t: Tables) -> DataFrame:
    """Rows per source that writing the English documents reports, for all sources."""
    english = t.documents.where("lang = 'en'").select("doc_id", F.col("source").alias("venue"), "text")
    return sinks.write_partitions(english, _folder(t, "documents"), covered=t.documents.select(F.col("source").alias("venue")))


@query(
    "q_append_twice",
    """
    select c_mktsegment as venue, c_custkey, count(*) as n from
        (select * from customer union all select * from customer) group by all
    """,
)
def append_twice(t: Tables) -> DataFrame:
    """Customers appended twice per segment."""
    path = _folder(t, "customers")
    rows = t.customer.select(F.col("c_mktsegment").alias("venue"), "c_custkey")
    for _ in range(2):
        sinks.append_rows(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("venue", "c_custkey").agg(F.count(F.lit(1)).alias("n"))
