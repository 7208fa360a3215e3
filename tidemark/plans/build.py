"""The whole lake: raw tables of one committed load to typed tables, marts and checks."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.runs import CHECK_RESULT, CRITICAL, append_check_results
from tidemark.operators.snapshot import conform_ledger, latest_committed_load
from tidemark.plans import checks, gold
from tidemark.plans.silver import MODELS, raw_schema
from tidemark.sources.bronze import dates_of, files_of, read_ledger, read_table
from tidemark.sources.layers import Lake


CONCURRENT_WRITES = 4
MARTS = (
    "dim_team",
    "dim_player",
    "fct_team_fixture",
    "mart_team_fixture_run",
    "mart_player_value",
    "mart_position_scarcity",
)


class NoCommittedLoad(RuntimeError):
    """There is no load a snapshot could be taken from."""


class BrokenChecks(RuntimeError):
    """Data checks that found violating rows."""


def build(
    spark: SparkSession, raw_root: str, lake: Lake, checked: bool = False, warn: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Build every model, then publish all of them at once; returns them as read back from the lake.

    The load id is resolved once, so all models see one snapshot even while another load
    commits. Of raw tables exactly the files are opened that the load's commit lists; for a load
    of another writer, those of its dates. Each model is written aside before the next one reads it: a mart scans Parquet
    columns instead of recomputing what is below it. Nothing is published before every model is
    written, has the columns that readers of the published one rely on, and, with `checked`, has
    passed its critical checks: the typed tables before any mart is built, then all the others.
    The checks that `warn` names are recorded like the others but stop nothing. What every check
    found is appended to the lake's check results (`runs.correctness_daily` reads them), also that
    of a build that was stopped.
    """
    mild = frozenset(warn)
    if unknown := mild - checks.check_names():
        raise ValueError(f"no such checks: {', '.join(sorted(unknown))}")
    ledger = read_ledger(spark, raw_root)
    load_id = latest_committed_load(ledger)
    if load_id is None:
        raise NoCommittedLoad(raw_root)
    dates, files = dates_of(ledger, load_id), files_of(spark, raw_root, load_id)
    published = lake.current(spark)
    work = lake.aside()
    built: dict[str, DataFrame] = {}
    contracts = {
        name: published.published_schema(spark, layer, name)
        for layer, names in (("silver", ["stg_fpl__loads", *MODELS]), ("gold", MARTS))
        for name in names
    }

    def put(layer: str, name: str, df: DataFrame) -> DataFrame:
        work.write(df, layer, name, contracts[name])
        built[name] = work.read(spark, layer, name)
        return built[name]

    def put_typed(name: str) -> None:
        model = MODELS[name]
        raw = read_table(spark, raw_root, model.raw, raw_schema(model), load_id, dates, model.optional, files)
        put("silver", name, model.build(raw, load_id))

    # The typed tables do not depend on each other; small ones fill the gaps of large ones.
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        loads = pool.submit(put, "silver", "stg_fpl__loads", conform_ledger(ledger))
        list(pool.map(put_typed, MODELS))
        loads.result()
    if checked:
        _stop_if_broken(spark, lake, work, checks.silver_checks(built), mild)

    silver = {name.removeprefix("stg_fpl__"): df for name, df in built.items()}
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        sides = pool.submit(put, "gold", "fct_team_fixture", gold.fct_team_fixture(silver["fixtures"]))
        teams = put("gold", "dim_team", gold.dim_team(silver["teams"], silver["players"]))
        players = pool.submit(
            put, "gold", "dim_player", gold.dim_player(silver["players"], teams, silver["positions"])
        )
        run = put(
            "gold",
            "mart_team_fixture_run",
            gold.mart_team_fixture_run(teams, silver["gameweeks"], sides.result()),
        )
        value = gold.mart_player_value(players.result(), silver["gameweeks"], run)
        worth = pool.submit(put, "gold", "mart_player_value", value)
        scarcity = gold.mart_position_scarcity(players.result(), silver["positions"], silver["game_settings"])
        put("gold", "mart_position_scarcity", scarcity)
        worth.result()
    if checked:
        known = checks.silver_checks(built)
        others = {n: df for n, df in checks.all_checks(built).items() if n not in known}
        _stop_if_broken(spark, lake, work, others, mild)
    lake.publish(spark, work)
    return built


def run_checks(built: dict[str, DataFrame], but: Iterable[str] = ()) -> DataFrame:
    """Failed checks of a build, one row each; an empty result means the build is sound."""
    left_out = set(but)
    found = {n: df for n, df in checks.all_checks(built).items() if n not in left_out}
    return checks.violations(found)


def _stop_if_broken(
    spark: SparkSession, lake: Lake, work: Lake, found: dict[str, DataFrame], warn: frozenset[str]
) -> None:
    """Record what the checks found, one row per check, and stop at critical ones that failed."""
    results = checks.graded(found, warn & set(found)).collect()
    name = work.root.rsplit("/", 1)[1]
    at = datetime.now(timezone.utc)
    rows = [(name, r.check_name, r.grade, r.violations, r.passed, at) for r in results]
    append_check_results(spark.createDataFrame(rows, CHECK_RESULT), lake.root)
    if failed := [r for r in results if r.grade == CRITICAL and not r.passed]:
        raise BrokenChecks(", ".join(f"{r.check_name} ({r.violations})" for r in failed))


def build_checked(
    spark: SparkSession, raw_root: str, lake: Lake, warn: Iterable[str] = ()
) -> dict[str, DataFrame]:
    """Build, check, and publish only what has passed all checks but those that may warn."""
    return build(spark, raw_root, lake, checked=True, warn=warn)
