"""End-to-end run of the study as a batch job: raw files in a landing folder
are checked against the manifest and loaded as text with lineage, then every
layer is published as a table in the ``bronze`` / ``silver`` / ``gold``
schemas (external tables in the shared checkpoint folder), documented, and
the quality checks and reports are built on them, so SQL written against
those table names runs as is.

    from tempora.plans import job
    out = job.run(spark, "/root/testdata/sf0.1")
    spark.sql("SELECT regime_vol, COUNT(*) FROM gold.fato_janela_cambial GROUP BY 1").show()
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators import quality as Q
from tempora.operators.clean import ledger_by_source, normalise_long
from tempora.plans import catalog, gold, reports
from tempora.plans import dictionary as D
from tempora.plans.series_catalogue import OUTLIER_CODES, REFERENCE_CODE, SERIES
from tempora.session import cut_lineage, scratch_path
from tempora.sources.arrays import INVALID, file_name, read_landing_files, render_landing_files, split_quarantine
from tempora.sources.fixtures import render_landing
from tempora.sources.ingest import LINEAGE_FILE, LINEAGE_TS, assert_manifest, ingest, manifest
from tempora.sources.publish import publish


def run(spark: SparkSession, sf_dir: str, document: bool = True, files: bool = False) -> dict[str, DataFrame]:
    """Render the six raw files from the test tables into a landing folder in
    the shared checkpoint folder, then ``run_from_landing``. With ``files``
    they are array and CSV files by year, some records of which cannot be read."""
    landing = scratch_path(spark, "landing")
    (render_landing_files if files else render_landing)(spark, sf_dir, landing)
    return run_from_landing(spark, landing, document=document, cutoff=gold.FIXTURE_CUTOFF, files=files)


def _tables(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """Bronze frames of a landing folder with one folder of JSON lines or CSV for each table."""
    frames = {}
    for spec in SERIES:
        json_like = spec.date_fmt == "dd/MM/yyyy"
        frames[spec.table] = ingest(spark, f"{landing.rstrip('/')}/{spec.table}", "json" if json_like else "csv",
                                    [spec.date_col, spec.value_col], **({} if json_like else {"header": "true"}))
    return frames


def _files(spark: SparkSession, landing: str, cutoff, out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Bronze frames of a landing folder with array and CSV files by table and
    year; publishes what could not be read, and what became of each file's records."""
    raw = cut_lineage(read_landing_files(spark, landing), "landing-records")
    good, bad = split_quarantine(raw)
    out["bronze.quarentena"] = publish(spark, "bronze.quarentena", bad.withColumn("arquivo", file_name(F.col(LINEAGE_FILE))))
    typed = normalise_long(raw, SERIES, keep=[file_name(F.col(LINEAGE_FILE)).alias("arquivo"), F.col(INVALID)])
    out["silver.controle_por_arquivo"] = publish(spark, "silver.controle_por_arquivo", ledger_by_source(
        typed, ["indicador"], ["arquivo"], cutoff=cutoff, unreadable=F.col(INVALID).isNotNull(), materialise=cut_lineage))
    return {s.table: good.filter(F.col("tabela") == s.table).select(
        F.col("data_txt").alias(s.date_col), F.col("valor_txt").alias(s.value_col), LINEAGE_FILE, LINEAGE_TS) for s in SERIES}


def run_from_landing(spark: SparkSession, landing: str, document: bool = True,
                     cutoff=gold.STUDY_CUTOFF, files: bool = False) -> dict[str, DataFrame]:
    """Landing manifest -> Bronze (six raw tables, all text, with lineage) ->
    Silver -> Gold -> quality -> reports. ``files``: the landing folder holds
    ``tabela=.../ano=...`` files (JSON arrays, CSV); records that cannot be
    read go to ``bronze.quarentena`` and are counted by file."""
    m = manifest(spark, landing, [f"tabela={s.table}" if files else s.table for s in SERIES])
    assert_manifest(m)
    for schema, comment in D.SCHEMA_COMMENTS.items():
        catalog.create_schema(spark, schema, comment, scratch_path(spark, f"schema-{schema}"))
    out: dict[str, DataFrame] = {"bronze.manifest": m}
    raw = _files(spark, landing, cutoff, out) if files else _tables(spark, landing)
    for table, frame in raw.items():
        out[f"bronze.{table}"] = publish(spark, f"bronze.{table}", frame)
    frames = {s.table: out[f"bronze.{s.table}"] for s in SERIES}
    clean, ledger = gold.silver(frames, cutoff=cutoff, materialise=cut_lineage)
    s = out["silver.serie_diaria"] = publish(spark, "silver.serie_diaria", clean)
    out["silver.controle_qualidade"] = publish(spark, "silver.controle_qualidade", ledger)
    daily = out["gold.fato_indicador_diario"] = publish(spark, "gold.fato_indicador_diario", gold.daily_fact(s))
    out["gold.dim_tempo"] = publish(spark, "gold.dim_tempo", gold.dim_time(s))
    out["gold.dim_indicador"] = publish(spark, "gold.dim_indicador", gold.dim_indicator(spark))
    wide = out["gold.fato_janela_cambial"] = publish(
        spark, "gold.fato_janela_cambial", gold.wide_fact(s, materialise=cut_lineage))
    if document:
        for t, comment in D.TABLE_COMMENTS.items():
            cols = dict(D.COLUMN_COMMENTS.get(t, {}))
            if t == "fato_janela_cambial":
                cols.update(catalog.horizon_comments(D.HORIZON_TEMPLATES))
            layer = "silver" if f"silver.{t}" in out else "gold"
            catalog.document(spark, f"{layer}.{t}", comment, cols)

    out["dq.reconcile"] = Q.reconcile(out["silver.controle_qualidade"], daily)
    out["dq.nulls"] = Q.null_profile(wide)
    out["dq.outliers"] = Q.zscore_outliers(daily, "indicador", "variacao_pct", OUTLIER_CODES,
                                           extra=[F.col("indicador"), F.col("data")])
    out["dq.lag"] = Q.publication_lag(s, REFERENCE_CODE)
    out["dq.gaps"] = Q.gaps(s)
    for name in ("yearly_behaviour", "step_distribution", "rolling_corr_by_year", "rise_by_regime",
                 "outcome_by_band", "band_regime_crosstab", "latest_snapshot", "carry_by_year",
                 "forward_vs_call"):
        out[f"report.{name}"] = getattr(reports, name)(wide)
    return out


def main(argv=None) -> None:
    """``python -m tempora.plans.job SF_DIR``: run the job on local test tables
    and print the row count of every published table (one small job each)."""
    import sys

    from tempora.session import clear_layers, layer_mark, local_session
    args = list(sys.argv[1:] if argv is None else argv)
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    mark = layer_mark()
    out = run(spark, sf_dir)
    for name, df in out.items():
        if name.split(".")[0] in ("bronze", "silver", "gold"):
            print(f"{name:32s} {df.count():>10d}")
    clear_layers(spark, mark)   # the tables are published; nothing reads the layers any more
    spark.stop()


if __name__ == "__main__":
    main()
