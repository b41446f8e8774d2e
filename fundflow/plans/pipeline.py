"""The model graph as lazy DataFrames, and its materialisation as tables.

``Models`` wires raw tables -> staging -> tags -> flow -> marts.  Every
attribute is a DataFrame built once per ``Models``.  Without a ``warehouse`` all
are lazy.  With one, each raw table and each table-layer model (tags, flow, marts)
is written there as Parquet by the first access that needs it, and read from
there by everything else.  The table-layer models read each raw table once or in a few columns, so
they are built from ``sources`` and write no raw table.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.keyword_match import collect_taxonomy, sort_keywords
from ..session import ensure_checkpoint_dir
from ..sources import lens, seeds
from ..sources.layouts import LINEAGE_COLUMNS, columns_of, raw_schema
from . import flows, marts, staging, tagging

# What the flow and the donor-industry table read of a tagged donation.
TAGGED_COLUMNS = ["transaction_id", "committee_id", "donor_name", "donor_employer",
                  "donor_occupation", "amount", "transaction_date", "election_type", "m", "cycle_year"]


class Models:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 taxonomy: DataFrame | None = None, categories: DataFrame | None = None,
                 keyword_rows: list[tuple] | None = None, dedupe_links: bool = False,
                 whole_words: bool = False, casefold_stop_list: bool = False,
                 latest_committee: bool = False, lenient_dates: bool = False):
        """``keyword_rows``: the taxonomy's rows when the caller already holds
        them (seeds are constants), which saves collecting the table.
        ``categories`` maps crosswalk codes to industries; without it (the
        default, as it has no public seed) the crosswalk layer matches nothing:
        read one with ``seeds.read_seed_csv``.

        Options, all off as in the source: ``dedupe_links`` credits a repeated
        committee-candidate link once; ``whole_words`` ignores keywords inside
        longer words of employers and committees; ``casefold_stop_list`` compares the employer stop list in
        any case; ``latest_committee`` keeps one committee row per id;
        ``lenient_dates`` turns impossible dates into NULL.
        """
        self.spark = spark
        self.sources = raw
        if taxonomy is None:
            keyword_rows = keyword_rows or seeds.taxonomy_rows()
            taxonomy = seeds.industry_taxonomy(spark)
        self.taxonomy = taxonomy
        self.categories = seeds.empty_categories(spark) if categories is None else categories
        self._keyword_rows = keyword_rows
        self.options = {"dedupe_links": dedupe_links, "whole_words": whole_words,
                        "casefold_stop_list": casefold_stop_list,
                        "latest_committee": latest_committee, "lenient_dates": lenient_dates}
        self._written: set[str] = set()

    @cached_property
    def keywords(self):
        if self._keyword_rows is not None:
            return sort_keywords(self._keyword_rows)
        return collect_taxonomy(self.taxonomy)

    @classmethod
    def from_lens(cls, spark: SparkSession, sf_dir: str, **options) -> "Models":
        return cls(spark, lens.lens_tables(spark, sf_dir), seeds.lens_taxonomy(spark),
                   seeds.lens_categories(spark),
                   keyword_rows=seeds.taxonomy_rows() + seeds.LENS_KEYWORDS, **options)

    # table layers ----------------------------------------------------------
    # A table counts as written only once it is whole: a failed build is
    # repeated by the next access, over the same path.
    warehouse: str | None = None
    rebuild = False                # whether tables of an earlier build are replaced

    def layer(self, name: str, build) -> bool:
        """Whether the table can be read from the warehouse, building it first if need be."""
        if self.warehouse is None:
            return False
        if name not in self._written:
            mark = f"{self.warehouse}/{name}-complete"
            if self.rebuild or not _is_there(self.spark, mark):
                build()
                self.spark.range(1).write.mode("overwrite").parquet(mark)
            self._written.add(name)
        return True

    def raw_table(self, name: str) -> DataFrame:
        """One raw table; with a warehouse, written there by (cycle, file)."""
        if not self.layer(f"raw-{name}", lambda: write_raw({name: self.sources[name]}, self.warehouse)):
            return self.sources[name]
        return self.spark.read.schema(raw_schema(columns_of(name))).parquet(f"{self.warehouse}/raw/{name}")

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """All raw tables, written together."""
        return dict(zip(self.sources, _at_once(self.raw_table, self.sources)))

    def _table(self, name: str, plan) -> DataFrame:
        """What ``plan()`` returns; with a warehouse, written there once and read back."""
        if not self.layer(name, lambda: plan().write.mode("overwrite").parquet(f"{self.warehouse}/{name}")):
            return plan()
        return self.spark.read.parquet(f"{self.warehouse}/{name}")

    # staging (views) -------------------------------------------------------
    @cached_property
    def candidates(self) -> DataFrame:
        return staging.stg_candidates(self.raw_table("candidates"))

    @cached_property
    def committees(self) -> DataFrame:
        return staging.stg_committees(self.raw_table("committees"),
                                      latest_per_id=self.options["latest_committee"])

    @cached_property
    def individual(self) -> DataFrame:
        return staging.stg_individual_contributions(self.raw_table("individual_contributions"),
                                                    lenient=self.options["lenient_dates"])

    @cached_property
    def pac(self) -> DataFrame:
        return staging.stg_pac_contributions(self.raw_table("pac_contributions"),
                                             lenient=self.options["lenient_dates"])

    @cached_property
    def profiles(self) -> DataFrame:
        return staging.candidate_profiles(self.raw_table("candidates"))

    @cached_property
    def linkage(self) -> DataFrame:
        return staging.stg_candidate_committee_linkage(self.raw_table("candidate_committee_linkage"))

    @cached_property
    def financials(self) -> DataFrame:
        return staging.stg_candidate_financial_summary(self.raw_table("candidate_financial_summary"))

    # intermediate (tables) -------------------------------------------------
    def _individual(self, keep: tuple = ()) -> DataFrame:
        return staging.stg_individual_contributions(self.sources["individual_contributions"],
                                                    self.options["lenient_dates"], keep)

    @cached_property
    def committee_tags(self) -> DataFrame:
        return self._table("committee_tags", lambda: tagging.committee_industry_tags(
            staging.stg_committees(self.sources["committees"], self.options["latest_committee"]), self.taxonomy,
            self.sources["opensecrets_committees"], self.categories,
            keywords=self.keywords, whole_words=self.options["whole_words"]))

    @cached_property
    def tagged_donations(self) -> DataFrame:
        return self._table("tagged_donations", lambda: tagging.tag_donations(
            self._individual(("cycle_year",)), self.taxonomy, self.keywords, self.options["casefold_stop_list"],
            self.options["whole_words"]).select(*TAGGED_COLUMNS))

    @cached_property
    def donor_industry(self) -> DataFrame:
        return tagging.individual_donor_industry(
            self._individual(), self.taxonomy, self.keywords, self.tagged_donations,
            self.options["casefold_stop_list"])

    @cached_property
    def flow_by_cycle(self) -> DataFrame:
        """The flow with the cycle of each transaction."""
        return self._table("flow_by_cycle", self._flow_by_cycle)

    def _flow_by_cycle(self) -> DataFrame:
        _at_once(lambda name: getattr(self, name), ("committee_tags", "tagged_donations"))
        pac = staging.stg_pac_contributions(self.sources["pac_contributions"], self.options["lenient_dates"],
                                            keep=("cycle_year",))
        linkage = staging.stg_candidate_committee_linkage(self.sources["candidate_committee_linkage"])
        return flows.contributions_to_candidates(
            pac, self._individual(), linkage, self.committee_tags, self.taxonomy,
            keywords=self.keywords, tagged=self.tagged_donations,
            dedupe_links=self.options["dedupe_links"], keep=("cycle_year",))

    @cached_property
    def flow(self) -> DataFrame:
        return self.flow_by_cycle.select(*flows.FLOW_COLUMNS)

    @cached_property
    def pair_sums(self) -> DataFrame:
        """Money and rows per candidate and paying (or receiving) committee, read by five reports."""
        return self._table("pair_sums", lambda: flows.pair_sums(self.flow_by_cycle))

    # marts (tables) --------------------------------------------------------
    def _financials(self) -> DataFrame:
        return staging.stg_candidate_financial_summary(self.sources["candidate_financial_summary"])

    @cached_property
    def funding_extras(self) -> DataFrame:
        return self._table("funding_extras", lambda: marts.funding_with_extras(
            self.flow, staging.stg_candidates(self.sources["candidates"]), self._financials()))

    @cached_property
    def funding(self) -> DataFrame:
        return self.funding_extras.select(*marts.FUNDING_COLUMNS)

    @cached_property
    def funding_by_cycle(self) -> DataFrame:
        """One row per candidate and cycle, with ``large_donor_total``."""
        return self._table("funding_by_cycle", lambda: marts.funding_by_cycle(
            self.flow_by_cycle, staging.candidate_profiles(self.sources["candidates"]), self._financials()))

    @cached_property
    def score_by_cycle(self) -> DataFrame:
        return marts.capture_score_by_cycle(self.funding_by_cycle)

    @cached_property
    def score(self) -> DataFrame:
        return self._table("score", lambda: marts.candidate_capture_score(self.funding_extras))


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.schema("id long").parquet(path).count() > 0
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return False
        raise


def write_raw(raw: dict[str, DataFrame], warehouse: str) -> None:
    """Raw tables below ``{warehouse}/raw``, partitioned by cycle and source file, replaced whole."""
    def write(item) -> None:
        name, df = item
        (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*LINEAGE_COLUMNS).parquet(f"{warehouse}/raw/{name}"))

    _at_once(write, raw.items())


def write_tables(tables: dict[str, DataFrame], warehouse: str) -> None:
    """Independent tables below ``warehouse``, replaced whole."""
    _at_once(lambda item: item[1].write.mode("overwrite").parquet(f"{warehouse}/{item[0]}"), tables.items())


def _at_once(run, items) -> list:
    """Independent jobs submitted together, so short ones fill each other's idle tasks; the first error is raised."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(run, items))


def materialize(models: Models, warehouse: str) -> None:
    """Write the table-layer models under ``warehouse`` (Parquet, replaced whole).

    Each table is computed from the lazy graph once and written; the next
    table reads its inputs back from the written ones, so no lineage is
    recomputed and an executor lost later cannot force a recompute.
    """
    built = Models(models.spark, models.sources, models.taxonomy, models.categories, models._keyword_rows,
                   **models.options)
    built.warehouse, built.rebuild = warehouse, True
    for names in (("flow_by_cycle",), ("pair_sums", "funding_extras", "funding_by_cycle"), ("score",)):
        _at_once(lambda name: getattr(built, name), names)


def source_version(spark: SparkSession, paths: list[str]) -> str:
    """Digest of what each path holds (bytes, files, time of change): other data is another version."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = []
    for p in paths:
        path = hadoop.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        held = fs.getContentSummary(path)
        found.append((p.rpartition("/")[2], held.getLength(), held.getFileCount(),
                      fs.getFileStatus(path).getModificationTime()))
    return hashlib.sha1(repr(found).encode()).hexdigest()[:12]


def warehouse_folder(spark: SparkSession, sf_dir: str) -> str:
    """Shared folder for the tables over one version of one input directory.

    Under ``fundflow.warehouse.dir`` when set (later applications then find the
    tables of an unchanged input complete and read them), else under the reliable
    checkpoint folder (``spark.checkpoint.dir``), which each application has its own of.
    """
    root = (spark.conf.get("fundflow.warehouse.dir", None)
            or ensure_checkpoint_dir(spark)).rstrip("/")
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    version = source_version(spark, [f"{sf_dir}/{t}.parquet" for t in lens.SOURCE_TABLES])
    return f"{root}/fundflow-warehouse/{tag}/{version}"
