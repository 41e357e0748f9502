"""The run registry and configuration audits, over one run per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.base import query, table
from textmill.functions import runs as N
from textmill.operators import audit
from textmill.operators import registry as G
from textmill.session import scratch_path
from textmill.sources.runs import read_runs as read_run_files

NOW = "2030-01-01T00:00:00+00:00"


def c(name):
    return F.col(name)


def sql_tag(n: str, digits: int = 1) -> str:
    forms = " ".join(
        f"WHEN {n} >= {10**p} THEN printf('%.{digits}f{u}', {n} / 1e{p})" for p, u in ((9, "B"), (6, "M"), (3, "K"))
    )
    return f"CASE WHEN {n} IS NULL THEN '?' {forms} ELSE {n}::VARCHAR END"


SQL_PARAMS = "(2 * v * e + b * e + 2 * e + l * (12 * e * e + 13 * e))::BIGINT"
SQL_RUNS = f"""(SELECT *, CASE WHEN o_orderkey % 17 = 0 THEN 'kept ' || o_orderkey ELSE name || '-v' || version || '-' || size_tag END AS folder
 FROM (SELECT *, {sql_tag("num_params")} AS size_tag FROM (SELECT *, {SQL_PARAMS} AS num_params FROM (SELECT o_orderkey, 'run ' || o_orderpriority AS name, o_orderkey::INT AS version,
 (64 + o_custkey % 4096)::INT AS v, (32 * (1 + o_orderkey % 16))::INT AS e, (1 + o_orderkey % 8)::INT AS h, (o_orderkey % 16)::INT AS l, (64 * (1 + o_custkey % 8))::INT AS b,
 o_custkey AS iteration, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey * 2 END AS max_iters, o_orderstatus <> 'P' AS has_weights,
 o_orderkey % 13 > 0 AS has_info, CASE WHEN o_orderkey % 11 > 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') END AS updated_at,
 CASE o_orderkey % 4 WHEN 0 THEN 'bpe' WHEN 1 THEN 'char' WHEN 2 THEN 'BPE' END AS tokenizer_type,
 CASE WHEN o_orderkey % 9 > 0 THEN floor(o_totalprice * 10)::BIGINT END AS dataset_chars FROM orders))))"""


def run_rows(spark, sf):
    o = table(spark, sf, "orders")
    key, cust = c("o_orderkey"), c("o_custkey")
    i = lambda x: x.cast("int")
    base = o.select(
        "o_orderkey", F.concat(F.lit("run "), "o_orderpriority").alias("name"), i(key).alias("version"),
        i(64 + cust % 4096).alias("vocab_size"), i(32 * (1 + key % 16)).alias("n_embed"), i(1 + key % 8).alias("n_head"),
        i(key % 16).alias("n_layer"), i(64 * (1 + cust % 8)).alias("block_size"), cust.alias("iteration"),
        F.when(key % 7 > 0, cust * 2).alias("max_iters"), (c("o_orderstatus") != "P").alias("has_weights"),
        (key % 13 > 0).alias("has_info"),
        F.when(key % 11 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).alias("updated_at"),
        F.when(key % 4 == 0, "bpe").when(key % 4 == 1, "char").when(key % 4 == 2, "BPE").alias("tokenizer_type"),
        F.when(key % 9 > 0, F.floor(c("o_totalprice") * 10)).alias("dataset_chars"),
    )
    sized = base.withColumn("num_params", N.param_count(c("vocab_size"), c("n_embed"), c("n_layer"), c("block_size")))
    folder = F.when(key % 17 == 0, F.concat(F.lit("kept "), key)).otherwise(
        N.run_folder(c("name"), c("version"), c("num_params"))
    )
    return sized.withColumns({"size_tag": N.size_tag(c("num_params")), "folder": folder})


def registry(spark, sf):
    """The tables ``folders`` and ``runs``; some folders have no metadata."""
    rows = run_rows(spark, sf)
    config = F.struct("tokenizer_type", "vocab_size", "n_embed", "n_head", "n_layer", "block_size", F.lit(0.1).alias("dropout"))
    infos = rows.filter("has_info").select(
        "folder", "name", "version", "size_tag", "num_params", "iteration", "max_iters", config.alias("config"),
        G.default_description(c("tokenizer_type"), c("dataset_chars")).alias("description"),
        c("updated_at").alias("created_at"), "updated_at",
    )
    return rows.select("folder", "has_weights"), infos


# ---------------------------------------------------------------- names and sizes

# Counts of all magnitudes, many of them halfway between two tags.
SQL_SIZES = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity * 250)::BIGINT * (1 + l_partkey * l_suppkey) AS n FROM lineitem)"


def sizes(spark, sf):
    n = F.round(c("l_quantity") * 250).cast("bigint") * (1 + c("l_partkey") * c("l_suppkey"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", n.alias("n"))


@query("size_tag", f"SELECT l_orderkey, l_linenumber, n, {sql_tag('n')} AS tag FROM {SQL_SIZES}")
def size_tag(spark, sf):
    return sizes(spark, sf).select("l_orderkey", "l_linenumber", "n", N.size_tag(c("n")).alias("tag"))


@query("size_tag2", f"SELECT l_orderkey, l_linenumber, n, {sql_tag('n', 2)} AS tag FROM {SQL_SIZES}")
def size_tag2(spark, sf):
    return sizes(spark, sf).select("l_orderkey", "l_linenumber", "n", N.size_tag(c("n"), 2).alias("tag"))


PATTERN = N.FOLDER_PATTERN


@query(
    "parse_run_folder",
    f"SELECT folder, CASE WHEN ok THEN regexp_extract(folder, '{PATTERN}', 1) END AS name, CASE WHEN ok THEN regexp_extract(folder, '{PATTERN}', 2)::INT END AS version, "
    f"CASE WHEN ok THEN regexp_extract(folder, '{PATTERN}', 3) END AS size FROM (SELECT folder, regexp_matches(folder, '{PATTERN}') AS ok FROM {SQL_RUNS})",
)
def parse_run_folder(spark, sf):
    rows = run_rows(spark, sf).select("folder", N.parse_folder(c("folder")).alias("p"))
    return rows.select("folder", "p.name", "p.version", "p.size")


@query("run_folder", f"SELECT o_orderkey, folder FROM {SQL_RUNS}")
def run_folder(spark, sf):
    return run_rows(spark, sf).select("o_orderkey", "folder")


@query("param_count", f"SELECT o_orderkey, num_params FROM {SQL_RUNS}")
def param_count(spark, sf):
    return run_rows(spark, sf).select("o_orderkey", "num_params")


# ---------------------------------------------------------------- registry


@query("next_version", f"SELECT name, max(version) + 1 AS next_version FROM {SQL_RUNS} WHERE o_orderkey % 17 > 0 GROUP BY name")
def next_version(spark, sf):
    return G.next_versions(registry(spark, sf)[0])


@query(
    "plan_folders",
    f"WITH r AS {SQL_RUNS}, n AS (SELECT name, max(version) + 1 AS nv FROM r WHERE o_orderkey % 17 > 0 GROUP BY name), "
    "w AS (SELECT DISTINCT name, 1500000 AS num_params FROM r UNION ALL SELECT 'new ' || r_name, 2000 FROM region) "
    "SELECT name, coalesce(nv, 1)::INT AS version, name || '-v' || coalesce(nv, 1) || '-' || CASE num_params WHEN 2000 THEN '2.0K' ELSE '1.5M' END AS folder FROM w LEFT JOIN n USING (name)",
)
def plan_folders(spark, sf):
    known = run_rows(spark, sf).select("name").distinct().withColumn("num_params", F.lit(1_500_000))
    new = table(spark, sf, "region").select(F.concat(F.lit("new "), "r_name").alias("name"), F.lit(2000).alias("num_params"))
    return G.plan_folders(known.unionByName(new), registry(spark, sf)[0])


SQL_LISTED = f"(SELECT folder, CASE WHEN has_info THEN updated_at END AS updated_at FROM {SQL_RUNS} WHERE has_weights)"


@query("list_runs", f"SELECT folder, updated_at FROM {SQL_LISTED}")
def list_runs(spark, sf):
    return G.list_runs(*registry(spark, sf))


@query("latest_run", f"SELECT folder, updated_at FROM {SQL_LISTED} ORDER BY coalesce(updated_at, '') DESC, folder DESC LIMIT 1")
def latest_run(spark, sf):
    return G.latest_run(*registry(spark, sf))


@query(
    "latest_per_name",
    f"SELECT name, folder FROM (SELECT name, folder, row_number() OVER (PARTITION BY name ORDER BY coalesce(updated_at, '') DESC, folder DESC) AS r "
    f"FROM {SQL_RUNS} WHERE has_weights AND has_info) WHERE r = 1",
)
def latest_per_name(spark, sf):
    return G.latest_per_name(*registry(spark, sf))


SQL_DESCRIPTION = """CASE WHEN lower(tokenizer_type) = 'bpe' THEN 'Byte-pair' ELSE 'Character-level' END || CASE WHEN coalesce(dataset_chars, 0) > 0
 THEN ' model trained on ' || format('{:,}', dataset_chars) || ' characters of text.' ELSE ' model.' END"""


@query(
    "run_details",
    f"""SELECT folder AS name, CASE WHEN has_info THEN name ELSE folder END AS display_name, CASE WHEN has_info THEN version END AS version,
 CASE WHEN has_info THEN size_tag END AS size_tag, CASE WHEN has_info THEN iteration END AS iter, CASE WHEN has_info THEN max_iters END AS max_iters,
 CASE WHEN has_info THEN num_params END AS num_params, CASE WHEN has_info THEN updated_at END AS created_at, CASE WHEN has_info THEN updated_at END AS updated_at,
 CASE WHEN has_info THEN {SQL_DESCRIPTION} END AS description FROM {SQL_RUNS} WHERE has_weights""",
)
def run_details(spark, sf):
    return G.run_details(*registry(spark, sf))


@query(
    "upsert_runs",
    f"SELECT folder, size_tag, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 2 = 1 THEN 'Character-level GPT trained on ' || format('{{:,}}', o_orderkey) || ' characters of text.' ELSE 'Character-level GPT trained from scratch.' END ELSE {SQL_DESCRIPTION} END AS description, "
    f"CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN iteration + 100 ELSE iteration END AS iteration, "
    f"CASE WHEN o_orderkey % 2 = 1 THEN coalesce(updated_at, CASE WHEN o_orderkey % 3 = 0 THEN '{NOW}' END) ELSE '{NOW}' END AS created_at, "
    f"CASE WHEN o_orderkey % 3 = 0 THEN '{NOW}' ELSE updated_at END AS updated_at FROM {SQL_RUNS} WHERE has_info AND (o_orderkey % 2 = 1 OR o_orderkey % 3 = 0)",
)
def upsert_runs(spark, sf):
    """Odd runs are stored; every third run comes in, some of them for the second time."""
    _, infos = registry(spark, sf)
    keyed = infos.join(run_rows(spark, sf).select("folder", "o_orderkey"), "folder")
    old = keyed.filter(c("o_orderkey") % 2 == 1).drop("o_orderkey")
    step = F.when(c("o_orderkey") % 2 == 1, 100).otherwise(0)
    new = keyed.filter(c("o_orderkey") % 3 == 0).withColumns(
        {
            "iteration": c("iteration") + step, "created_at": F.lit(None).cast("string"),
            "description": F.when(c("o_orderkey") % 5 == 0, c("description")),
            "dataset_chars": F.when(c("o_orderkey") % 2 == 1, c("o_orderkey").cast("bigint")),
        }
    )
    done = G.upsert_runs(old, new.drop("o_orderkey"), F.lit(NOW))
    return done.select("folder", "size_tag", "description", "iteration", "created_at", "updated_at")


SQL_LEGACY = f"(SELECT max(num_params) AS num_params, max(iteration) AS iteration FROM {SQL_RUNS})"


@query(
    "migrate_plan",
    f"SELECT 'run 5-LOW' AS name, v AS version, 'run 5-LOW-v' || v || '-' || {sql_tag('num_params')} AS folder, {sql_tag('num_params')} AS size_tag, num_params, iteration "
    f"FROM {SQL_LEGACY}, (SELECT max(version) + 1 AS v FROM {SQL_RUNS} WHERE NOT has_weights AND o_orderkey % 17 > 0 AND name = 'run 5-LOW')",
)
def migrate_plan(spark, sf):
    """A legacy checkpoint next to folders that hold no weights."""
    rows = run_rows(spark, sf)
    legacy = rows.agg(F.max("num_params").alias("num_params"), F.max("iteration").alias("iteration"))
    return G.migrate_plan(legacy, rows.filter(~c("has_weights")).select("folder", "has_weights"), "run 5-LOW")


@query(
    "read_runs",
    f"SELECT 'at=' || replace(name, 'run ', '') AS path_folder, name, max(version) AS version, count(*) AS iteration, max(num_params) AS num_params FROM {SQL_RUNS} GROUP BY name",
)
def read_runs(spark, sf):
    """One metadata file per name, written to its folder and read back."""
    root = scratch_path(spark, "runs")
    per_name = run_rows(spark, sf).groupBy("name").agg(
        F.max("version").alias("version"), F.count("*").alias("iteration"), F.max("num_params").alias("num_params")
    )
    doc = F.to_json(F.struct("name", "version", "iteration", "num_params"))
    files = per_name.select(doc.alias("value"), F.replace("name", F.lit("run "), F.lit("")).alias("at"))
    files.repartition("at").write.partitionBy("at").text(root)
    return read_run_files(spark, root, "*").select("path_folder", "name", "version", "iteration", "num_params")


@query(
    "vocab_mismatch",
    f"SELECT folder, v AS vocab_size, v + 4 AS tokenizer_vocab FROM {SQL_RUNS} WHERE has_info AND o_orderkey % 5 = 0",
)
def vocab_mismatch(spark, sf):
    _, infos = registry(spark, sf)
    extra = F.when(c("o_orderkey") % 5 == 0, 4).otherwise(0)
    tokenizers = run_rows(spark, sf).select("folder", (c("vocab_size") + extra).alias("vocab_size"))
    return G.vocab_mismatch(infos, tokenizers)


# ---------------------------------------------------------------- audits


@query(
    "config_audit",
    f"""WITH a AS (SELECT *, CASE WHEN dataset_chars > 0 AND num_params > 0 THEN dataset_chars / num_params END AS ratio FROM {SQL_RUNS})
 SELECT o_orderkey, num_params, round(num_params * 16.0::DOUBLE / 1048576, 6) AS total_mib, round(ratio, 9) AS ratio,
 CASE WHEN ratio IS NULL THEN 'unknown' WHEN ratio < 0.1::DOUBLE THEN 'very little' WHEN ratio < 0.5::DOUBLE THEN 'small' ELSE 'enough' END AS band,
 concat_ws('; ', CASE WHEN e % h <> 0 THEN 'width is not a multiple of the heads' END, CASE WHEN l <= 0 THEN 'layers are not positive' END,
 CASE WHEN dataset_chars IS NULL THEN 'the data set is absent' END) AS errors,
 concat_ws('; ', CASE WHEN tokenizer_type = 'char' THEN 'the tokenizer is character level' END, CASE WHEN tokenizer_type IS NULL THEN 'the tokenizer type is unknown' END,
 CASE WHEN ratio < 0.1::DOUBLE THEN 'the data set is very small for the model' END) AS warnings,
 e % h = 0 AND l > 0 AND dataset_chars IS NOT NULL AS go FROM a""",
)
def config_audit(spark, sf):
    a = audit.config_audit(run_rows(spark, sf))
    return a.select(
        "o_orderkey", "num_params", F.round("memory.total", 6).alias("total_mib"), F.round("ratio", 9).alias("ratio"), "band",
        F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"), "go",
    )


@query(
    "run_ratio",
    f"WITH r AS {SQL_RUNS} SELECT folder, num_params, round(num_params / (SELECT num_params FROM r WHERE o_orderkey = 1), 9) AS multiple FROM r",
)
def run_ratio(spark, sf):
    out = audit.size_multiple(run_rows(spark, sf), c("o_orderkey") == 1)
    return out.withColumn("multiple", F.round("multiple", 9))
