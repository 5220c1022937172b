"""Queries on groups, hashes and components."""

from __future__ import annotations

from pyspark.sql import functions as F

from crestline.operators.clustering import CLUSTERS, cluster_document, cluster_domains, domain_files, exact_groups, group_members, group_rows, preview, ranked_groups, representatives, size_histogram, summary, union_counts
from crestline.operators.components import connected, label_nodes, star_edges
from crestline.operators.linkage import minimum_forest, single_linkage
from crestline.operators.similarity import ahash_bits, dhash_bits, gate_pairs, hash_classes, phash_bits, similar_groups
from crestline.plans.scratch import Scratch
from crestline.plans.session import table
from crestline.sources.sinks import write_cluster_document, write_cluster_files

EMBEDDING_GATE = (18, 20, 20)  # for blocks that are no images, whose distances are larger
GROUPS = 100
LINK_DISTANCE = 10


def _files(spark, folder):
    return domain_files(table(spark, folder, "extraction_results").drop("loaded_at").distinct(), ["result_id"])


def _hashes(spark, folder):
    return table(spark, folder, "hashes").select("ord", "domain", "p", "d").distinct()


def last_files(spark, folder):
    return _files(spark, folder).select("domain", "logo_url", "path")


def url_star_edges(spark, folder):
    rows = _files(spark, folder).where("logo_url <> ''")
    return star_edges(rows, "logo_url", "domain", "ord")


def text_digest_groups(spark, folder):
    """Pages with the same text: groups by digest and their star edges."""
    docs = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("digest"))
    return star_edges(docs, "digest", "doc_id", "doc_id")


def url_components(spark, folder):
    return exact_groups(_files(spark, folder))


def url_groups_ranked(spark, folder):
    return ranked_groups(url_components(spark, folder)).select("group_id", "component", "size")


def url_group_members(spark, folder):
    """Members of every group in order, a row each."""
    return group_members(url_components(spark, folder)).withColumnRenamed("member", "domain")


def url_group_sizes(spark, folder):
    return size_histogram(url_components(spark, folder))


def url_group_summary(spark, folder):
    return summary(url_components(spark, folder))


def url_group_preview(spark, folder):
    return preview(url_components(spark, folder))


def url_representatives(spark, folder):
    files = _files(spark, folder)
    return representatives(exact_groups(files), files).select("component", "domain")


def embedding_bits(spark, folder):
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", phash_bits(e).alias("p"), dhash_bits(e).alias("d"), ahash_bits(e).alias("a"))


def embedding_pairs(spark, folder):
    """Pairs of different hashes, each by its first row."""
    return gate_pairs(embedding_bits(spark, folder), "vec_id", EMBEDDING_GATE)


def embedding_classes(spark, folder):
    """The first row with the same hashes, for every row: the members of the pairs."""
    return hash_classes(embedding_bits(spark, folder), "vec_id").select(F.col("k").alias("vec_id"), F.col("class").alias("class_id"))


def embedding_components(spark, folder):
    return similar_groups(embedding_bits(spark, folder), "vec_id", EMBEDDING_GATE).withColumnRenamed("node", "vec_id")


def hash_components(spark, folder):
    """Rows of hashes with the least row of their group; a row without hashes is its own."""
    rows = _hashes(spark, folder)
    found = similar_groups(rows).withColumnRenamed("node", "ord")
    return rows.select("ord").distinct().join(found, "ord", "left").select("ord", F.coalesce("component", "ord").alias("component"))


def single_linkage_groups(spark, folder):
    """Rows of hashes merged to a hundred groups."""
    return single_linkage(_hashes(spark, folder), GROUPS).withColumnRenamed("node", "ord")


def single_linkage_cut(spark, folder):
    """Rows of hashes merged as long as the distance is at most that of the gate: as many groups as the links within it leave.

    Whole distances are merged or not, so no tie decides and SQL can follow the links.
    """
    rows = _hashes(spark, folder).dropna(subset=["ord", "p"])
    forest = minimum_forest(rows).where(F.col("d") <= LINK_DISTANCE)
    return label_nodes(rows, forest.select(F.col("i").alias("src"), F.col("j").alias("dst")), "ord").withColumnRenamed("node", "ord")


def single_linkage_merges(spark, folder):
    """Merges at every distance up to that of the gate."""
    return minimum_forest(_hashes(spark, folder)).where(F.col("d") <= LINK_DISTANCE).groupBy("d").agg(F.count(F.lit(1)).alias("merges"))


def cluster_pipeline(spark, folder):
    """Domains by shared address, then by similar hashes of the groups' representatives."""
    return cluster_domains(_files(spark, folder), _hashes(spark, folder))


def cluster_pipeline_k(spark, folder):
    """Domains by shared address, then merged by nearest hashes down to one group: only groups without a hash stay."""
    return cluster_domains(_files(spark, folder), _hashes(spark, folder), k=1)


def cluster_report(spark, folder):
    """What the document of a run over all tables holds, a row per member."""
    cut = Scratch(spark, "report")
    files, results = cut.cut(_files(spark, folder)), table(spark, folder, "extraction_results")
    failed = results.select("domain").where("domain is not null").distinct().join(files.select("domain"), "domain", "left_anti")
    labels = cut.cut(cluster_pipeline(spark, folder))
    totals = summary(labels).select(*(F.col(c).cast("int").alias(c) for c in ("total_domains", "total_groups", "multi_groups", "singletons")), F.lit(1).alias("one"))
    failed = failed.agg(F.count(F.lit(1)).cast("int").alias("failed")).withColumn("one", F.lit(1))
    # one row each
    return group_rows(labels, files).withColumn("one", F.lit(1)).join(F.broadcast(totals.join(failed, "one")), "one").drop("one")


def connected_pairs(spark, folder):
    """C4: whether the two domains of every stored match share an address, directly or through others."""
    pairs = table(spark, folder, "match_pairs").select("pair_id", F.col("domain_a").alias("a"), F.col("domain_b").alias("b"))
    return connected(url_components(spark, folder).withColumnRenamed("domain", "node"), pairs).select("pair_id", "connected")


def phase_merges(spark, folder):
    """Groups that each phase merges into others: by address, then by similar hashes."""
    cut = Scratch(spark, "phases")
    files = cut.cut(_files(spark, folder))
    alone = files.select("domain", F.col("domain").alias("component"))
    steps = union_counts([alone, cut.cut(exact_groups(files)), cut.cut(cluster_domains(files, _hashes(spark, folder)))])
    return spark.createDataFrame(list(zip(("address", "hash"), steps)), "phase string, merges long")


def document_written(spark, folder):
    """K4: the document of a run, written as JSON and read again."""
    cut = Scratch(spark, "document")
    files = cut.cut(_files(spark, folder))
    failed = table(spark, folder, "domains").select("domain").where("domain is not null").distinct().join(files, "domain", "left_anti")
    write_cluster_document(cluster_document(cut.cut(exact_groups(files)), files, failed), f"{cut.root}/json")
    doc = spark.read.schema(CLUSTERS).json(f"{cut.root}/json")
    return doc.select("total_domains", "total_groups", "multi_groups", "singletons", F.size("failed_domains").alias("failed"), "parameters.t1_phash", "parameters.k_clusters", F.size("groups").alias("held"), F.aggregate("groups", F.lit(0), lambda n, g: n + F.size(g["domains"])).alias("members"))


def folders_written(spark, folder):
    """K5: files by the number of their group, written and read again."""
    cut = Scratch(spark, "folders")
    files = cut.cut(_files(spark, folder))
    rows = cut.cut(group_rows(cut.cut(exact_groups(files)), files))
    named = rows.join(files.select("domain", "path"), "domain").select("group_id", "path")
    write_cluster_files(named, f"{cut.root}/groups")
    return spark.read.parquet(f"{cut.root}/groups").groupBy("group_id").agg(F.count(F.lit(1)).alias("files"), F.min("name").alias("first_name"))


def stored_groups(spark, folder):
    """Groups of stored runs as rows, each run once."""
    runs = table(spark, folder, "clustering_results").select("run_id", F.col("parameters.t1_phash").alias("t1"), F.inline("groups"))
    return runs.select("run_id", "t1", "group_id", "count", F.array_join("domains", ",").alias("domains"), "representative_logo").distinct()


QUERIES = {f.__name__: f for f in (
    last_files, url_star_edges, text_digest_groups, url_components, url_groups_ranked, url_group_members, url_group_sizes, url_group_summary, url_group_preview, url_representatives,
    embedding_bits, embedding_pairs, embedding_components, hash_components, embedding_classes, single_linkage_groups, single_linkage_cut, single_linkage_merges, cluster_pipeline, cluster_pipeline_k, cluster_report, connected_pairs, phase_merges, document_written, folders_written, stored_groups)}

_F = """o AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM extraction_results WHERE domain IS NOT NULL AND downloaded_path <> '' AND coalesce(error, '') = ''),
  f AS (SELECT domain, arg_max({'u': logo_url}, result_id).u AS logo_url, arg_max(downloaded_path, result_id) AS path, min(result_id) AS ord FROM o GROUP BY domain),
  h AS (SELECT logo_url, arg_min(domain, ord) AS head FROM f WHERE logo_url <> '' GROUP BY logo_url),
  s AS (SELECT h.head AS src, f.domain AS dst FROM f JOIN h USING (logo_url) WHERE h.head <> f.domain)"""
# a domain has one address, so address groups are stars
_G = f"""{_F}, z AS (SELECT domain, coalesce(min(domain) OVER (PARTITION BY nullif(logo_url, '')), domain) AS m, nullif(logo_url, '') AS u FROM f),
  g AS (SELECT domain, CASE WHEN u IS NULL THEN domain ELSE m END AS component FROM z),
  t AS (SELECT component, count(*) AS size, min(domain) AS first_domain, string_agg(domain, ',' ORDER BY domain) AS domains FROM g GROUP BY component)"""
_BITS = """x AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings),
  y AS (SELECT vec_id, e, list_sort(e) AS s, list_sum(e) / 64 AS mean FROM x),
  b AS (SELECT vec_id, unnest(range(64)) AS i, e, s, mean FROM y),
  v AS (SELECT vec_id, i, e[i + 1] * 2 > s[32] + s[33] AS pb, e[(i // 8) * 8 + (i + 1) % 8 + 1] > e[i + 1] AS db, e[i + 1] > mean AS ab FROM b),
  w AS (SELECT vec_id, i, CASE WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i) END AS k, pb, db, ab FROM v),
  q AS (SELECT vec_id, coalesce(sum(k) FILTER (pb), 0)::BIGINT AS p, coalesce(sum(k) FILTER (db), 0)::BIGINT AS d, coalesce(sum(k) FILTER (ab), 0)::BIGINT AS a FROM w GROUP BY vec_id)"""
_EP = f"""{_BITS}, q1 AS (SELECT min(vec_id) AS vec_id, p, d FROM q GROUP BY p, d), e AS (SELECT l.vec_id AS i, r.vec_id AS j, bit_count(xor(l.p, r.p))::INT AS p_dist, bit_count(xor(l.d, r.d))::INT AS d_dist FROM q1 l JOIN q1 r ON l.vec_id < r.vec_id
        WHERE bit_count(xor(l.p, r.p)) <= 18 OR (bit_count(xor(l.p, r.p)) <= 20 AND bit_count(xor(l.d, r.d)) <= 20))"""
_HP = """hh AS (SELECT DISTINCT ord, domain, p, d FROM hashes),
  e AS (SELECT l.ord AS i, r.ord AS j FROM hh l JOIN hh r ON l.ord < r.ord WHERE bit_count(xor(l.p, r.p)) <= 10 OR (bit_count(xor(l.p, r.p)) <= 12 AND bit_count(xor(l.d, r.d)) <= 10))"""
_REACH = "ways AS (SELECT i AS x, j AS y FROM e UNION SELECT j, i FROM e), reach(n, c) AS (SELECT x, x FROM ways UNION SELECT reach.n, ways.y FROM reach JOIN ways ON reach.c = ways.x), comp AS (SELECT n, min(c) AS c FROM reach GROUP BY n)"
_BUCKET = "CASE WHEN size = 1 THEN '1' WHEN size <= 5 THEN '2-5' WHEN size <= 10 THEN '6-10' WHEN size <= 25 THEN '11-25' WHEN size <= 50 THEN '26-50' WHEN size <= 100 THEN '51-100' ELSE '100+' END"
_LINKED = f"""hh AS (SELECT DISTINCT ord, p FROM hashes WHERE ord IS NOT NULL AND p IS NOT NULL), e AS (SELECT l.ord AS i, r.ord AS j FROM hh l JOIN hh r ON l.ord < r.ord WHERE bit_count(xor(l.p, r.p)) <= {LINK_DISTANCE})"""
# merges up to a distance: rows less groups of the links within it
_MERGED = f"""hh AS (SELECT DISTINCT ord, p FROM hashes WHERE ord IS NOT NULL AND p IS NOT NULL),
  e AS (SELECT l.ord AS i, r.ord AS j, bit_count(xor(l.p, r.p))::INT AS w FROM hh l JOIN hh r ON l.ord <> r.ord WHERE bit_count(xor(l.p, r.p)) <= {LINK_DISTANCE}),
  steps AS (SELECT unnest(range({LINK_DISTANCE + 1}))::INT AS t),
  reach(t, n, c) AS (SELECT t, ord, ord FROM hh, steps UNION SELECT reach.t, reach.n, e.j FROM reach JOIN e ON reach.c = e.i AND e.w <= reach.t),
  done AS (SELECT t, (count(DISTINCT n) - count(DISTINCT c))::BIGINT AS merges FROM (SELECT t, n, min(c) AS c FROM reach GROUP BY t, n) GROUP BY t)"""
_PARTS = f"""{_G}, r AS (SELECT g.component, arg_min(g.domain, f.ord) AS domain, min(f.ord) AS ord FROM g JOIN f USING (domain) GROUP BY g.component),
  k AS (SELECT DISTINCT r.component FROM r JOIN hashes hs ON hs.domain = r.domain WHERE hs.p IS NOT NULL AND hs.d IS NOT NULL)"""
_PIPE = f"""{_G}, r AS (SELECT g.component, arg_min(g.domain, f.ord) AS domain, min(f.ord) AS ord FROM g JOIN f USING (domain) GROUP BY g.component),
  k AS (SELECT DISTINCT r.component, hs.p, hs.d FROM r JOIN hashes hs ON hs.domain = r.domain WHERE hs.p IS NOT NULL AND hs.d IS NOT NULL),
  e AS (SELECT l.component AS i, m.component AS j FROM k l JOIN k m ON l.component < m.component WHERE bit_count(xor(l.p, m.p)) <= 10 OR (bit_count(xor(l.p, m.p)) <= 12 AND bit_count(xor(l.d, m.d)) <= 10)),
  {_REACH}, fin AS (SELECT g.domain, coalesce(comp.c, g.component) AS component FROM g LEFT JOIN comp ON comp.n = g.component)"""
SQL = {
    "last_files": f"WITH {_F} SELECT domain, logo_url, path FROM f",
    "url_star_edges": f"WITH {_F} SELECT src, dst FROM s",
    "text_digest_groups": "SELECT src, dst FROM (SELECT min(doc_id) OVER (PARTITION BY md5(text)) AS src, doc_id AS dst FROM documents WHERE text IS NOT NULL) WHERE src <> dst",
    "url_components": f"WITH {_G} SELECT domain, component FROM g",
    "url_groups_ranked": f"WITH {_G} SELECT row_number() OVER (ORDER BY size DESC, first_domain) AS group_id, component, size FROM t",
    "url_group_members": f"WITH {_G} SELECT component, row_number() OVER (PARTITION BY component ORDER BY domain) AS place, domain FROM g",
    "url_group_sizes": f"WITH {_G} SELECT {_BUCKET} AS bucket, count(*) AS groups, sum(size)::BIGINT AS members FROM t GROUP BY 1",
    "url_group_summary": f"""WITH {_G} SELECT sum(size)::BIGINT AS total_domains, count(*) AS total_groups, count(*) FILTER (size > 1) AS multi_groups, count(*) FILTER (size = 1) AS singletons,
        max(size) AS largest, avg(size) FILTER (size > 1) AS avg_multi FROM t""",
    "url_group_preview": f"""WITH {_G}, n AS (SELECT *, row_number() OVER (ORDER BY size DESC, first_domain) AS group_id FROM t)
        SELECT group_id, size, array_to_string(string_split(domains, ',')[1:6], ', ') || CASE WHEN size > 6 THEN ', ... +' || (size - 6) ELSE '' END AS members FROM n WHERE group_id <= 25""",
    "url_representatives": f"WITH {_G} SELECT g.component, arg_min(g.domain, f.ord) AS domain FROM g JOIN f USING (domain) GROUP BY g.component",
    "embedding_bits": f"WITH {_BITS} SELECT vec_id, p, d, a FROM q",
    "embedding_pairs": f"WITH {_EP} SELECT * FROM e",
    "embedding_classes": f"WITH {_BITS} SELECT vec_id, min(vec_id) OVER (PARTITION BY p, d) AS class_id FROM q",
    "embedding_components": f"WITH RECURSIVE {_EP}, {_REACH} SELECT q.vec_id, coalesce(comp.c, q1.vec_id) AS component FROM q JOIN q1 USING (p, d) LEFT JOIN comp ON comp.n = q1.vec_id",
    "single_linkage_cut": f"WITH RECURSIVE {_LINKED}, {_REACH} SELECT DISTINCT hh.ord, coalesce(comp.c, hh.ord) AS component FROM hh LEFT JOIN comp ON comp.n = hh.ord",
    "single_linkage_merges": f"WITH RECURSIVE {_MERGED} SELECT y.t AS d, y.merges - coalesce(z.merges, 0) AS merges FROM done y LEFT JOIN done z ON z.t = y.t - 1 WHERE y.merges > coalesce(z.merges, 0)",
    "cluster_pipeline_k": f"""WITH {_PARTS} SELECT g.domain, CASE WHEN k.component IS NULL THEN g.component ELSE first.component END AS component
        FROM g LEFT JOIN k USING (component) CROSS JOIN (SELECT arg_min(component, ord) AS component FROM r WHERE component IN (SELECT component FROM k)) first""",
    "hash_components": f"WITH RECURSIVE {_HP}, {_REACH} SELECT DISTINCT hh.ord, coalesce(comp.c, hh.ord) AS component FROM hh LEFT JOIN comp ON comp.n = hh.ord",
    "cluster_pipeline": f"WITH RECURSIVE {_PIPE} SELECT domain, component FROM fin",
    "cluster_report": f"""WITH RECURSIVE {_PIPE}, u AS (SELECT fin.component, count(*) AS size, min(fin.domain) AS first_domain, arg_min(f.path, f.ord) AS representative_logo
        FROM fin JOIN f USING (domain) GROUP BY fin.component),
  n AS (SELECT *, row_number() OVER (ORDER BY size DESC, first_domain)::INT AS group_id FROM u)
        SELECT (SELECT count(*) FROM fin)::INT AS total_domains, (SELECT count(*) FROM u)::INT AS total_groups, (SELECT count(*) FROM u WHERE size > 1)::INT AS multi_groups, (SELECT count(*) FROM u WHERE size = 1)::INT AS singletons,
        (SELECT count(DISTINCT domain) FROM extraction_results WHERE domain IS NOT NULL AND domain NOT IN (SELECT domain FROM f))::INT AS failed,
        n.group_id, n.size::INT AS count, n.representative_logo, row_number() OVER (PARTITION BY fin.component ORDER BY fin.domain)::INT AS place, fin.domain FROM fin JOIN n USING (component)""",
    "connected_pairs": f"""WITH {_G} SELECT pair_id, coalesce(coalesce(x.component, m.domain_a) = coalesce(y.component, m.domain_b), false) AS connected
        FROM match_pairs m LEFT JOIN g x ON x.domain = m.domain_a LEFT JOIN g y ON y.domain = m.domain_b""",
    "phase_merges": f"""WITH RECURSIVE {_PIPE} SELECT 'address' AS phase, (SELECT count(*) FROM f) - (SELECT count(DISTINCT component) FROM g) AS merges
        UNION ALL SELECT 'hash', (SELECT count(DISTINCT component) FROM g) - (SELECT count(DISTINCT component) FROM fin)""",
    "document_written": f"""WITH {_G} SELECT sum(size)::INT AS total_domains, count(*)::INT AS total_groups, (count(*) FILTER (size > 1))::INT AS multi_groups, (count(*) FILTER (size = 1))::INT AS singletons,
        (SELECT count(DISTINCT domain) FROM domains WHERE domain NOT IN (SELECT domain FROM f))::INT AS failed, 10 AS t1_phash, NULL::INT AS k_clusters, count(*)::INT AS held, sum(size)::INT AS members FROM t""",
    "folders_written": f"""WITH {_G}, n AS (SELECT component, row_number() OVER (ORDER BY size DESC, first_domain)::INT AS group_id FROM t)
        SELECT group_id, count(*) AS files, min(group_id || '_' || regexp_extract(path, '([^/]*)$', 1)) AS first_name FROM n JOIN g USING (component) JOIN f USING (domain) GROUP BY group_id""",
    "stored_groups": """SELECT DISTINCT run_id, t1, g.group_id AS group_id, g.count AS count, array_to_string(g.domains, ',') AS domains, g.representative_logo AS representative_logo
        FROM (SELECT run_id, parameters.t1_phash AS t1, unnest(groups) AS g FROM clustering_results)""",
}
