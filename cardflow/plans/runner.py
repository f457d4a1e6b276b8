"""Run all five steps in one session: ingest -> transform -> reports.

The reference chains five separate driver processes and passes data only
through catalog tables.  Here the steps are plain calls; an exception in one
stops those that read its tables (the reference's return-code gating).  Each
step still writes its tables and the next step reads them back, which cuts the
lineage at the same places and lets a lost executor recompute only the current
step.  Steps 1-3 read no table of each other and are submitted together, and so
are the tables that one step writes from the same frame.

Tables are written under the version of their run and take their published
names together, after the last step: until then the tables of the run before
stay as they are.  A manifest records the finished steps, so a run that failed
goes on at the step where it stopped, if its inputs are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardflow.config import Settings
from cardflow.functions import fixed
from cardflow.operators.validate import CODE
from cardflow.plans import ingest, sinks, transform
from cardflow.plans.manifest import PUBLISHED, Manifest, fingerprint, step_key
from cardflow.session import materialize, scratch_path
from cardflow.sources import csv, fixtures


@dataclass
class RawInputs:
    customers: DataFrame
    sanctioned: DataFrame
    accounts: DataFrame
    transactions: DataFrame


def inputs_from_tables(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(fixtures.raw_customers(spark, sf_dir), fixtures.raw_sanctioned(spark, sf_dir),
                     fixtures.raw_accounts(spark, sf_dir), fixtures.raw_transactions(spark, sf_dir))


def inputs_from_files(spark: SparkSession, s: Settings) -> RawInputs:
    """The four raw files in the input folder of the settings."""
    if not s.input_path:
        raise ValueError("the settings name no input folder (InputFilePath)")
    at = s.input_path.rstrip("/")
    return RawInputs(csv.read_customers(spark, f"{at}/{s.customer_file}"),
                     csv.read_sanctioned(spark, f"{at}/{s.sanctioned_file}"),
                     csv.read_accounts(spark, f"{at}/{s.account_file}"),
                     csv.read_transactions(spark, f"{at}/{s.transaction_file}"))


def table_paths(s: Settings, root: str) -> dict[str, str]:
    """Where each table goes: the settings' own folders, else below `root`."""
    def under(folder: str | None, name: str) -> str:
        return sinks.table_path(folder or root, name)

    return {
        "customer_stage": under(s.output_path, "customer_stage"),
        "account_stage": under(s.temp_path, "account_stage"),
        "transaction_stage": s.transaction_path or under(None, "transaction_stage"),
        "intermediate": under(s.inter_table_path, "card_intermediate"),
        "customer_rejects": under(s.reject_path, "customer_rejects"),
        "account_rejects": under(s.reject_path, "account_rejects"),
        "transaction_rejects": under(s.reject_path, "transaction_rejects"),
        "orphans": under(s.reject_path, "orphan_rejects"),
    }


@dataclass
class RunResult:
    database: str
    root: str
    #: Published names, configured folders, and where in them the tables of this run are.
    tables: dict[str, str] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    versions: dict[str, str] = field(default_factory=dict)
    views: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    #: Steps that an earlier, failed run had done.
    resumed: list[str] = field(default_factory=list)

    def files(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of the run, read by path (its buckets bind no plan)."""
        return sinks.read_files(spark, self.tables[name], self.versions[name])


#: Published table of each result of a run.
NAMES = {"customer_stage": "customer_stage", "customer_rejects": "customer_rejects", "account_stage": "account_stage",
         "account_rejects": "account_rejects", "transaction_stage": "transaction_stage",
         "transaction_rejects": "transaction_rejects", "orphans": "orphan_rejects", "intermediate": "card_intermediate",
         "previous": "card_previous", "geography": "card_geography", "years": "card_years", "customer_casts": "customer_cast_losses", "account_casts": "account_cast_losses"}
#: Tables beside the results: those derived from the intermediate one, and the audits of the casts.
BESIDE = ("previous", "geography", "years", "customer_casts", "account_casts")


class _Run:
    """One run: where its tables go, and which of its steps are done."""

    def __init__(self, spark: SparkSession, s: Settings, root: str, db: str) -> None:
        self.spark, self.db = spark, db
        self.manifest = Manifest.open(spark, root, s.as_of)
        day = s.as_of or self.manifest.day() or spark.range(1).select(F.current_date()).first()[0]
        self.s = replace(s, as_of=day)  # one day for all steps, also of a run over midnight
        self.result = RunResult(db, root, paths=table_paths(s, root))
        self.observations: dict[str, Observation] = {}

    def suffix(self) -> str:
        return f"__{self.manifest.run}"

    def staged(self, name: str) -> str:
        return NAMES[name] + self.suffix()

    def path(self, name: str) -> str:
        return f"{self.result.paths[name].rstrip('/')}/version={self.manifest.run}"

    def observe(self, name: str) -> Callable[[DataFrame], DataFrame]:
        obs = self.observations[name] = Observation(name)
        return lambda df: df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def table(self, name: str) -> str:
        """The name of a table of this run, before or after it was published."""
        staged = f"{sinks.quoted(self.db)}.{sinks.quoted(self.staged(name))}"
        return staged if self.spark.catalog.tableExists(staged) else f"{sinks.quoted(self.db)}.{sinks.quoted(NAMES[name])}"

    def read(self, name: str) -> DataFrame:
        return sinks.read_files(self.spark, self.table(name), self.result.versions[name])

    def resume(self, name: str, key: str | None, tables: list[str]) -> bool:
        """Take the tables of a step from the open run if it had done it on the same inputs."""
        done = self.manifest.done(name, key)
        if not done or not all(self._there(t) for t in tables):
            return False
        self.result.versions |= done["tables"]
        self.result.counts |= done["counts"]
        self.result.resumed.append(name)
        return True

    def step(self, name: str, key: str | None, tables: list[str], work: Callable[[], None]) -> None:
        """Do a step and record it."""
        work()
        versions = {t: self.path(t) for t in tables}
        counts = {t: int(self.observations[t].get["rows"]) for t in tables}
        self.result.versions.update(versions)
        self.result.counts.update(counts)
        self.manifest.add(name, key, versions, counts, self.s.as_of)

    def steps(self, *steps: tuple[str, str | None, list[str], Callable[[], None]]) -> None:
        """Steps that do not read each other's tables: those not taken from the open run are
        done together.  If one fails the others are still finished and recorded, so the next
        run repeats only the failed one."""
        todo = [s for s in steps if not self.resume(*s[:3])]
        sinks.together([partial(self.step, *s) for s in todo])

    def _there(self, name: str) -> bool:
        return any(self.spark.catalog.tableExists(f"{sinks.quoted(self.db)}.{sinks.quoted(t)}")
                   for t in (self.staged(name), NAMES[name]))


def run_steps(spark: SparkSession, inputs: RawInputs, s: Settings = Settings(), root: str | None = None,
              database: str | None = None, cache: bool = False) -> RunResult:
    """All steps.  Each checked or joined frame that feeds two tables is written to
    the shared folder once; the next step reads the tables by path.  With `cache`
    the intermediate table is cached until the caller uncaches it.

    A run below the `root` of a run that failed goes on with it: steps that were done on the
    same input files and settings are not repeated.  Without a `root` every run is new."""
    root = root or scratch_path(spark, "run")
    db = database or s.database
    sinks.create_database(spark, db, sinks.table_path(root, "_db"))
    run = _Run(spark, s, root, db)
    s, res = run.s, run.result
    keys = {"customers": step_key(s, fingerprint(inputs.customers, inputs.sanctioned)),
            "accounts": step_key(s, fingerprint(inputs.accounts)),
            "transactions": step_key(s, fingerprint(inputs.transactions))}
    keys["transform"] = step_key(*keys.values())

    def audit(checked: DataFrame, source: str, casts: dict) -> None:
        name = f"{source}_casts"
        path = f"{sinks.table_path(s.reject_path or root, NAMES[name])}/version={run.manifest.run}"
        sinks.save_table(ingest.cast_losses(checked, source, casts), f"{sinks.quoted(db)}.{sinks.quoted(run.staged(name))}", path)

    def customers() -> None:
        checked = materialize(ingest.check_customers(inputs.customers, inputs.sanctioned, s), "checked-customers")
        accepted = ingest.customer_stage(checked)
        sinks.together([
            lambda: sinks.write_customer_stage(
                accepted, db, run.path("customer_stage"),
                s.co_partition or sinks.directory_buckets(accepted, sinks.CUSTOMER_DIRECTORIES, s),
                run.staged("customer_stage"), run.observe("customer_stage")),
            lambda: sinks.write_rejects(ingest.customer_rejects(checked), db, run.path("customer_rejects"),
                                        run.staged("customer_rejects"), run.observe("customer_rejects")),
            lambda: audit(checked, "customer", ingest.customer_casts())])

    def accounts() -> None:
        checked = materialize(ingest.check_accounts(inputs.accounts), "checked-accounts")
        sinks.together([
            lambda: sinks.write_account_stage(ingest.account_stage(checked), db, run.path("account_stage"),
                                              run.staged("account_stage"), run.observe("account_stage"),
                                              s.co_partition),
            lambda: sinks.write_rejects(ingest.account_rejects(checked), db, run.path("account_rejects"),
                                        run.staged("account_rejects"), run.observe("account_rejects")),
            lambda: audit(checked, "account", ingest.account_casts())])

    def transactions() -> None:
        checked = materialize(ingest.check_transactions(inputs.transactions, s.transaction_key), "checked-transactions")
        sinks.together([
            lambda: sinks.write_transaction_stage(ingest.transaction_stage(checked), db, run.path("transaction_stage"),
                                                  run.staged("transaction_stage"), run.observe("transaction_stage"),
                                                  s.co_partition),
            lambda: sinks.write_rejects(ingest.transaction_rejects(checked), db, run.path("transaction_rejects"),
                                        run.staged("transaction_rejects"), run.observe("transaction_rejects"))])

    def transformed() -> None:
        """From the files of the stage tables, or from their buckets."""
        stages = ("transaction_stage", "account_stage", "customer_stage")
        if s.co_partition:
            with transform.co_partitioned(spark):
                joined = materialize(transform.enrich_by_buckets(*[spark.table(run.table(n)) for n in stages], s.co_partition), "joined")
        else:
            joined = materialize(transform.enrich(*map(run.read, stages)), "joined")
        sinks.together([lambda: sinks.write_rejects(transform.orphans(joined), db, run.path("orphans"),
                                                    run.staged("orphans"), run.observe("orphans")),
                        lambda: intermediate(joined)])

    def intermediate(joined: DataFrame) -> None:
        inter = transform.within_limit(transform.metrics(transform.valid_joined(joined), s)).select(
            *transform.intermediate_columns(s))
        inter = materialize(run.observe("intermediate")(inter), "intermediate")
        table, _ = sinks.write_intermediate(
            inter, db, res.paths["intermediate"].rstrip("/"), sinks.directory_buckets(inter, sinks.INTERMEDIATE_DIRECTORIES, s),
            run.suffix(), f"/version={run.manifest.run}")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('as_of' = '{s.as_of}')")

    run.steps(("customers", keys["customers"], ["customer_stage", "customer_rejects"], customers),
              ("accounts", keys["accounts"], ["account_stage", "account_rejects"], accounts),
              ("transactions", keys["transactions"], ["transaction_stage", "transaction_rejects"], transactions))
    run.steps(("transform", keys["transform"], ["orphans", "intermediate"], transformed))

    # The tables take their names, and the views are made over them.
    for name, table in NAMES.items():
        sinks.publish(spark, db, table, run.staged(name))
    res.tables = {name: f"{sinks.quoted(db)}.{sinks.quoted(table)}" for name, table in NAMES.items() if name not in BESIDE}
    if cache:
        sinks.cache_table(spark, res.tables["intermediate"])
    res.views = sinks.create_report_views(spark, db, s)
    run.manifest.add(PUBLISHED, None, res.versions, res.counts, s.as_of)
    return res


def check_files(spark: SparkSession, s: Settings) -> dict[str, float]:
    """The gate before the first write: the share of misfit records of each raw file, and a
    ValueError that names the files over the share that the settings allow."""
    if s.bad_share is None:
        return {}
    at = s.input_path.rstrip("/")
    shares = csv.bad_shares(spark, {
        "customers": (f"{at}/{s.customer_file}", csv.CUSTOMER_DDL, None),
        "accounts": (f"{at}/{s.account_file}", csv.ACCOUNT_DDL, None),
        "transactions": (f"{at}/{s.transaction_file}", csv.TRANSACTION_DDL, fixed.ACCOUNT_DATE_FORMAT),
        "sanctioned": (f"{at}/{s.sanctioned_file}", "COUNTRY string", None)})
    over = {name: share for name, share in shares.items() if share > s.bad_share}
    if over:
        raise ValueError(f"more than {s.bad_share:.2%} of the records do not fit: " + ", ".join(
            f"{name} {share:.2%}" for name, share in over.items()))
    return shares


def run_from_config(spark: SparkSession, config_path: str, root: str | None = None, **overrides) -> RunResult:
    """The whole run from a parameter file: its input folder to its output folders."""
    s = Settings.from_csv(spark, config_path, **overrides)
    check_files(spark, s)
    return run_steps(spark, inputs_from_files(spark, s), s, root=root)


def stage_counts(inputs: RawInputs, s: Settings = Settings()) -> DataFrame:
    """Rows per step and outcome (accepted or reason code) as one frame."""
    return counts_from_checked(ingest.check_customers(inputs.customers, inputs.sanctioned, s),
                               ingest.check_accounts(inputs.accounts),
                               ingest.check_transactions(inputs.transactions, s.transaction_key), s)


def counts_from_checked(cc: DataFrame, ca: DataFrame, ct: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Stage counts from the three checked frames (written ones, ideally)."""
    def by_reason(checked: DataFrame, step: str) -> DataFrame:
        return checked.groupBy(F.coalesce(F.col(CODE), F.lit("accepted")).alias("outcome")).agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "outcome", "rows")

    joined = transform.enrich(ingest.transaction_stage(ct), ingest.account_stage(ca), ingest.customer_stage(cc))
    m = transform.metrics(joined, s)
    outcome = (F.when(F.col("Acct_open_dt").isNull() | F.col("FIRST_NAME").isNull(), F.lit("orphan"))
               .when(F.col("Cust_credit_limit_remaining") >= 0, F.lit("accepted"))
               .otherwise(F.lit("over_limit")))
    joined_counts = m.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("transform").alias("step"), "outcome", "rows")
    return (by_reason(cc, "customer").unionByName(by_reason(ca, "account"))
            .unionByName(by_reason(ct, "transaction")).unionByName(joined_counts))
