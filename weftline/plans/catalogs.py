"""The catalog as a written table: built, kept up by batches, read by range."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weftline.functions import scalars as X
from weftline.operators.catalog import Catalog
from weftline.plans.queries import RUNS, query
from weftline.sources import fixtures as S
from weftline.sources.shared import shared_dir

_KEPT = ["key", "run_id", "status", "at_us"]


@query(f"""WITH {RUNS}, k AS (SELECT *, CAST(right(run_id, 10) AS BIGINT) AS n, 'run:' || workflow_name || ':' || lpad(CAST(created_us // 1000 AS VARCHAR), 13, '0') || ':' || run_id AS key FROM runs),
 c AS (SELECT *, n % 4 > 0 AND deployment_id <> 'dep_7' AS changed FROM k)
 SELECT key, run_id, CASE WHEN changed THEN 'batch ' || CAST(n % 4 AS VARCHAR) ELSE status END AS status, CASE WHEN changed THEN created_us + n % 4 ELSE created_us END AS at_us FROM c
 WHERE (changed AND deployment_id <> 'dep_0' OR NOT changed AND n % 3 <> 0) AND starts_with(key, 'run:2-HIGH:') AND key > 'run:2-HIGH:0800000000000' AND key < 'run:2-HIGH:0850000000000'""")
def catalog_batches(spark, sf_dir):
    """A catalog built from two runs in three and kept up by three batches with deletions and fenced runs, read by range."""
    runs = S.runs(spark, sf_dir).withColumn("n", F.substring("run_id", 6, 10).cast("long"))
    key, _ = X.run_keys({c: F.col(c) for c in runs.columns})
    keyed = runs.select(key.alias("key"), "run_id", "status", F.col("created_us").alias("at_us"), "n", "deployment_id")
    catalog = Catalog(spark, f"{shared_dir(spark)}/catalog-{uuid.uuid4().hex}")
    catalog.build(keyed.where("n % 3 <> 0").select(_KEPT))
    fences = keyed.where("deployment_id = 'dep_7'").select("run_id")
    for batch in (1, 2, 3):
        changed = keyed.where(F.col("n") % 4 == batch)
        changed = changed.select("key", "run_id", F.lit(f"batch {batch}").alias("status"), (F.col("at_us") + batch).alias("at_us"), (F.col("deployment_id") == "dep_0").alias("deleted"))
        catalog.merge(changed, fences)
    return catalog.read(keyed.select(_KEPT).schema, "run:2-HIGH:", "run:2-HIGH:0800000000000", "run:2-HIGH:0850000000000")
