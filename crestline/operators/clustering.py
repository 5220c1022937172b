"""The clusterer as one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crestline.functions import fixed_values as V
from crestline.operators.components import label_nodes, star_edges
from crestline.operators.linkage import single_linkage
from crestline.operators.joins import spread_join
from crestline.operators.ranks import numbered
from crestline.operators.similarity import similar_groups
from crestline.plans.scratch import Scratch

CLUSTERS = (
    "total_domains int, total_groups int, multi_groups int, singletons int, failed_domains array<string>, "
    "parameters struct<hash_size:int,norm_size:int,t1_phash:int,t2_phash:int,t2_dhash:int,k_clusters:int>, time_s double, "
    "groups array<struct<group_id:int,count:int,domains:array<string>,representative_logo:string>>"
)


def is_ok(path: Column, error: Column) -> Column:
    """a non-empty path and no error."""
    return F.coalesce(path != "", F.lit(False)) & (F.coalesce(error, F.lit("")) == "")


def domain_files(results: DataFrame, order: list[str]) -> DataFrame:
    """(domain, logo_url, path, ord) of the ok rows; of a repeated domain the last row by ``order`` counts, ``ord`` is its first."""
    ok = results.where(is_ok(F.col("downloaded_path"), F.col("error")) & F.col("domain").isNotNull())
    key = F.struct(*order)
    return ok.groupBy("domain").agg(F.max_by(F.struct("logo_url", F.col("downloaded_path").alias("path")), key).alias("r"), F.min(key).alias("ord")).select("domain", "r.logo_url", "r.path", "ord")


def exact_groups(files: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Phases 1 and 2: (domain, component) by shared address and by shared file content (domain, digest)."""
    edges = star_edges(files.where("logo_url <> ''"), "logo_url", "domain", "ord")
    if digests is not None:
        edges = edges.unionByName(star_edges(files.join(digests, "domain"), "digest", "domain", "ord"))
    return label_nodes(files, edges, "domain").withColumnRenamed("node", "domain")


def representatives(groups: DataFrame, files: DataFrame) -> DataFrame:
    """(component, domain, ord): the first member of every group that has a file."""
    held = F.min(F.struct("ord", "domain"))
    return groups.join(files, "domain").where("path <> ''").groupBy("component").agg(held.alias("r")).select("component", "r.domain", "r.ord")


def cluster_domains(files: DataFrame, hashes: DataFrame, digests: DataFrame | None = None, k: int | None = None, gate: tuple[int, int, int] = V.GATE) -> DataFrame:
    """(domain, component): phases 1, 2 and 4. ``hashes``: (domain, p, d) and maybe ord, by which the first of several hashes of
    a domain counts (else the least); a group whose representative has no hash stays as it is.

    With ``k``, the first field of ``ord`` must be a whole number that tells the representatives apart.
    """
    cut = Scratch(files.sparkSession, "clusters")
    exact = cut.cut(exact_groups(files, digests))
    reps = cut.cut(representatives(exact, files))
    order = ["ord"] if "ord" in hashes.columns else []
    own = hashes.where("domain is not null and p is not null and d is not null").groupBy("domain").agg(F.min(F.struct(*order, "p", "d")).alias("h")).select("domain", "h.p", "h.d")
    known = cut.cut(reps.join(own, "domain"))
    if k is None:
        merged = similar_groups(known.select("component", "p", "d"), "component", gate)
    else:
        # groups go by their representative's place, as ties are broken by it; no ranking of all groups is needed for that
        place = F.col(f"ord.{known.schema['ord'].dataType.names[0]}") if isinstance(known.schema["ord"].dataType, T.StructType) else F.col("ord")
        named = known.select("component", "p", place.cast("long").alias("n"))
        found = single_linkage(named, k, "n", unhashed=reps.count() - known.count())
        names = named.select("n", "component")
        merged = spread_join(cut.cut(found.join(names.select(F.col("n").alias("node"), F.col("component").alias("c")), "node")), names.select(F.col("n").alias("component"), F.col("component").alias("m")), ["component"])
        merged = merged.select(F.col("c").alias("node"), F.col("m").alias("component"))
    # what a component becomes; the domains of a giant one stay where they are
    return spread_join(exact, merged.select(F.col("node").alias("component"), F.col("component").alias("new")), ["component"], "left").select("domain", F.coalesce("new", "component").alias("component"))


def group_stats(labels: DataFrame, node: str = "domain") -> DataFrame:
    """(component, size, first_node), combined before the shuffle."""
    return labels.groupBy("component").agg(F.count(F.lit(1)).cast("int").alias("size"), F.min(node).alias("first_node"))


def ranked_groups(labels: DataFrame, node: str = "domain") -> DataFrame:
    """Groups by size, then first member; ``group_id`` from 1.

    Places come from a range sort and counts per range: no task sees all groups, nor all of one size.
    """
    placed = numbered(group_stats(labels, node), [F.desc("size"), F.col("first_node")], "group_id")
    return placed.select(F.col("group_id").cast("int").alias("group_id"), "component", "size", "first_node")


def group_members(labels: DataFrame, node: str = "domain") -> DataFrame:
    """(component, place, member): members of the groups in order, from 1, a row each, so a giant group is many rows in many tasks."""
    cut = Scratch(labels.sparkSession, "members")
    rows = cut.cut(numbered(labels.select("component", F.col(node).alias("member")), ["component", "member"], "at"))
    first = rows.groupBy("component").agg(F.min("at").alias("first"))
    return spread_join(rows, first, ["component"]).select("component", (F.col("at") - F.col("first") + 1).cast("int").alias("place"), "member")


def size_bucket(size: Column) -> Column:
    """G11."""
    w = F
    for lo, hi, name in V.SIZE_BUCKETS:
        w = w.when((size >= lo) & (size <= hi) if hi else size >= lo, name)
    return w


def size_histogram(labels: DataFrame, node: str = "domain") -> DataFrame:
    return group_stats(labels, node).groupBy(size_bucket(F.col("size")).alias("bucket")).agg(F.count(F.lit(1)).alias("groups"), F.sum("size").alias("members"))


def summary(labels: DataFrame, node: str = "domain") -> DataFrame:
    """Counts of groups and the mean size of those with several members."""
    s = F.col("size")
    return group_stats(labels, node).agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_domains"), F.count(F.lit(1)).alias("total_groups"), F.count_if(s > 1).alias("multi_groups"),
        F.count_if(s == 1).alias("singletons"), F.max("size").alias("largest"), F.avg(F.when(s > 1, s)).alias("avg_multi"))


def preview(labels: DataFrame, node: str = "domain", groups: int = 25, names: int = 6) -> DataFrame:
    """The largest groups with their first members."""
    top = group_stats(labels, node).orderBy(F.desc("size"), "first_node").limit(groups)
    # ranked among themselves: ``groups`` rows
    top = top.withColumn("group_id", F.row_number().over(W.orderBy(F.desc("size"), "first_node")))
    held = labels.join(F.broadcast(top), "component").select("group_id", "size", F.col(node).alias("m"))
    # a rank that is limited before the shuffle as well: a giant group leaves ``names`` rows a task
    place = F.row_number().over(W.partitionBy("group_id", "size").orderBy("m"))
    least = held.withColumn("__k", place).where(F.col("__k") <= names).groupBy("group_id", "size").agg(F.array_sort(F.collect_list("m")).alias("__first"))
    more = F.when(F.col("size") > names, F.concat(F.lit("... +"), (F.col("size") - names).cast("string")))
    return least.select("group_id", "size", F.concat_ws(", ", "__first", more).alias("members"))


def group_rows(labels: DataFrame, files: DataFrame) -> DataFrame:
    """What the document of a run holds, as rows: (group_id, count, representative_logo, place, domain), one per member."""
    first_file = labels.join(files.where("path <> ''"), "domain").groupBy("component").agg(F.min(F.struct("ord", "path")).getField("path").alias("representative_logo"))
    heads = ranked_groups(labels).join(first_file, "component", "left").select("component", "group_id", F.col("size").alias("count"), "representative_logo")
    cut = Scratch(labels.sparkSession, "rows")
    return spread_join(cut.cut(group_members(labels)), cut.cut(heads), ["component"]).select("group_id", "count", "representative_logo", "place", F.col("member").alias("domain"))


def cluster_document(labels: DataFrame, files: DataFrame, failed: DataFrame, k: int | None = None, gate: tuple[int, int, int] = V.GATE, time_s: float = 0.0) -> DataFrame:
    """The one nested document of a run. It holds all domains by definition; ``group_rows`` has the same for anything larger."""
    members = F.transform(F.array_sort(F.collect_list(F.struct("place", "domain"))), lambda m: m["domain"])
    groups = group_rows(labels, files).groupBy("group_id", "count", "representative_logo").agg(members.alias("domains"))
    doc = groups.agg(F.array_sort(F.collect_list(F.struct("group_id", "count", "domains", "representative_logo"))).alias("groups"))
    bad = failed.agg(F.array_sort(F.collect_list("domain")).alias("failed_domains"))
    params = F.struct(*(F.lit(v).cast("int").alias(n) for n, v in zip(("hash_size", "norm_size", "t1_phash", "t2_phash", "t2_dhash", "k_clusters"), (V.HASH_SIDE, V.NORM_SIDE, *gate, k))))
    stats = summary(labels)
    # three tables of one row each
    one = [x.withColumn("__one", F.lit(1)) for x in (doc, bad, stats)]
    return one[0].join(one[1], "__one").join(one[2], "__one").select(
        *(F.col(c).cast("int").alias(c) for c in ("total_domains", "total_groups", "multi_groups", "singletons")), "failed_domains", params.alias("parameters"), F.lit(time_s).alias("time_s"), "groups")


def union_counts(steps: list[DataFrame]) -> list[int]:
    """Merges by each phase, from the labels after it: the drop in the number of groups."""
    counts = [s.select("component").distinct().count() for s in steps]
    return [a - b for a, b in zip(counts, counts[1:])]


