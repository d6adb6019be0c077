"""The stages from index membership to scores. Each reads tables, works on what isn't done yet and writes a new state.

Only the landing of files (membership, downloads) runs on the driver, within the data provider's rate; the stages over
texts are DataFrame jobs, one write for each table.
"""

from __future__ import annotations

import csv
import datetime
import gzip
import io
import json
import logging
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, sections
from ..operators import diagnose, score, select
from ..schema import of_stack
from ..sources import edgar, lexicon, raw
from ..sources.store import Store, replaced_members, require_unique, with_status
from .config import Config

log = logging.getLogger(__name__)


def now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass
class Job:
    spark: SparkSession
    config: Config
    fetch: edgar.Fetch | None = None

    @property
    def store(self) -> Store:
        return Store(self.spark, self.config.tables, self.config.buckets).ensure()

    def fetched(self, url: str) -> bytes:
        self.fetch = self.fetch or edgar.fetcher(self.config.user_agent, self.config.rate_limit)
        return self.fetch(url)

    def tickers(self, refresh: bool = False) -> DataFrame:
        data = edgar.cached(self.config.tickers, edgar.TICKERS_URL, self.fetched, refresh, edgar.WEEK)
        return edgar.read_tickers(self.spark.createDataFrame([(data.decode(),)], "json string"))

    def resolve(self, wanted: list[str], refresh: bool = False) -> tuple[dict[str, int], list[str]]:
        """Numbers of tickers, as they were asked for, and those without one; the list is fetched anew once it is a week old."""
        data = edgar.cached(self.config.tickers, edgar.TICKERS_URL, self.fetched, refresh, edgar.WEEK)
        known = edgar.known_tickers(self.spark, self.config.tickers, data)
        found = {w: known.get(w.strip().upper().replace(".", "-")) for w in wanted}
        return {w: c for w, c in found.items() if c is not None}, [w for w, c in found.items() if c is None]

    # stages

    def membership(self) -> dict[str, int]:
        page = self.fetched(edgar.MEMBERS_URL)
        edgar.write_atomically(self.config.snapshots / f"{now()[:10]}.html", page)
        found = select.resolved_members(edgar.members_frame(self.spark, page.decode()), self.tickers())
        members = require_unique(replaced_members(found, now()), ["ticker"])
        self.store.replace("members", members)
        return self.store.read("members").agg(F.count("*").alias("members"), F.count_if(F.col("cik").isNull()).alias("unresolved")).first().asDict()

    def landing(self, cik: int, accession: str, stack: str) -> Path:
        return self.config.raw(stack) / str(cik) / accession

    def land(self, cik: int, row: dict, stack: str) -> None:
        """The document first, then metadata.json, which marks it complete."""
        folder = self.landing(cik, row["accession"], stack)
        url = f"{names.ARCHIVES_BASE}{cik}/{row['accession'].replace('-', '')}/{row['primary_doc']}"
        body = self.fetched(url)
        edgar.write_atomically(folder / ("primary.html.gz" if self.config.gzip else "primary.html"), gzip.compress(body) if self.config.gzip else body)
        edgar.write_atomically(folder / "metadata.json", json.dumps(row | {"cik": cik, "url": url}).encode())

    #: Landed filings after which their rows are written, so that a run that breaks off loses no more than these.
    BATCH = 200

    def listed(self, targets: list, refresh: bool) -> tuple[dict[str, tuple[int, str]], int]:
        """Local pages of the companies' filing lists, with number and ticker, and how many companies failed."""
        pages, failed = {}, 0
        for target in targets:
            try:
                found = edgar.submissions(target["cik"], self.config.submissions, self.fetched, names.SUBMISSIONS_BASE, refresh)
            except Exception as e:
                log.warning("company %s: %s", target["cik"], e)
                failed += 1
                continue
            pages |= {str(p): (target["cik"], target["ticker"]) for p in found}
        return pages, failed

    def download(self, stack: str = "sp500", ciks: list[int] | None = None, limit: int | None = None, refresh: bool = False) -> dict[str, int]:
        """Land the missing filings of the universe; a company's or filing's failure is counted and the rest goes on.

        All lists are one DataFrame; only filings that have no row or no complete files come here one by one.
        """
        wanted = self.spark.createDataFrame([(c,) for c in ciks], "cik bigint") if ciks else None
        targets = select.universe(self.store.read("members"), of_stack(stack), wanted).collect()
        pages, failed = self.listed(targets, refresh)
        counts = {"new": 0, "skipped": 0, "failed": failed}
        if not pages:
            return counts
        owners = self.spark.createDataFrame([(Path(p).name, *who) for p, who in pages.items()], "page string, cik bigint, ticker string")
        listed = edgar.listed_filings(edgar.read_submissions(self.spark, list(pages))).join(F.broadcast(owners), "page")
        filings = self.store.stage("listed", select.target_filings(listed, list(self.config.form_types), self.config.history_start, self.config.amendments).dropDuplicates(["accessionNumber", "cik"]))
        marks = raw.completed(self.spark, str(self.config.raw(stack)))
        have = select.complete_filings(self.store.read("filings"), marks).select(F.col("accession").alias("accessionNumber"))
        missing = filings.join(have, "accessionNumber", "left_anti")
        counts["skipped"] = filings.count() - missing.count()
        landed: list[dict] = []
        for r in missing.orderBy("cik", "accessionNumber").toLocalIterator():
            if limit is not None and counts["new"] >= limit:
                break
            row = {"accession": r["accessionNumber"], "form_type": r["form"], "filing_date": r["filingDate"], "acceptance_dt": r["acceptance_dt"], "period_of_report": r["reportDate"] or None, "primary_doc": r["primaryDocument"], "ticker": r["ticker"], "stack": stack}
            try:
                self.land(r["cik"], row, stack)
            except Exception as e:
                log.warning("filing %s: %s", row["accession"], e)
                counts["failed"] += 1
                continue
            landed.append(row | {"cik": r["cik"], "raw_path": str(self.landing(r["cik"], row["accession"], stack).relative_to(self.config.data_root)), "downloaded_at": now()})
            counts["new"] += 1
            if len(landed) == self.BATCH:
                self.record(landed)
                landed = []
        self.record(landed)
        return counts

    def record(self, landed: list[dict]) -> None:
        """Rows of landed filings into the table, and their accessions into the log."""
        if not landed:
            return
        spec = "accession string, cik bigint, ticker string, form_type string, period_of_report string, acceptance_dt string, filing_date string, primary_doc string, raw_path string, stack string, downloaded_at string"
        columns = [c.split()[0] for c in spec.split(", ")]
        self.store.append_new("filings", self.spark.createDataFrame([tuple(x[c] for c in columns) for x in landed], spec))
        with (self.config.logs / "downloaded.log").open("a") as f:
            f.writelines(x["accession"] + "\n" for x in landed)

    def chosen(self, stack: str) -> DataFrame:
        return raw.preferred(raw.list_files(self.spark, str(self.config.raw(stack))))

    def with_statuses(self, status: DataFrame) -> None:
        """The filings of status (accession, parse_status) get theirs; others aren't written."""
        self.store.upsert("filings", with_status(self.store.read("filings").join(status.select("accession"), "accession", "left_semi"), status))

    def parse(self, stack: str = "sp500", ciks: list[int] | None = None, limit: int | None = None, force: bool = False) -> dict[str, int]:
        """A limit counts filings that parse: rounds of so many as are still wanted, until there are none."""
        counts, first = {"parsed": 0, "failed": 0, "suspicious": 0}, True
        tried = self.spark.createDataFrame([], "accession string")
        while first or (limit is not None and counts["parsed"] < limit):
            found, tried = self._parse(stack, ciks, None if limit is None else limit - counts["parsed"], force, tried)
            counts = {k: counts[k] + found[k] for k in counts}
            first = False
            if not found["parsed"] + found["failed"]:
                break
        return counts

    def _parse(self, stack: str, ciks: list[int] | None, limit: int | None, force: bool, tried: DataFrame) -> tuple[dict[str, int], DataFrame]:
        filings, texts, records = (self.store.read(n) for n in ("filings", "texts", "records"))
        open_ = filings.where(F.col("stack") == of_stack(stack)).join(tried, "accession", "left_anti")
        todo = self.store.stage("to_parse", select.to_parse(open_, texts, records, force, ciks, limit))
        files = raw.contents(self.spark, str(self.config.raw(stack)), self.chosen(stack).join(todo.select("accession"), "accession", "left_semi"))
        done = self.store.stage("parsed", raw.parsed(files, todo))
        new = done.join(todo.select("accession", "cik", "form_type"), "accession").withColumns({"status": F.col("full.status"), "parsed_at": F.lit(now())})
        self.store.upsert("records", new.drop("text"), ["accession"])
        self.store.upsert("texts", done.where("text is not null").select("accession", F.lit("full").alias("section"), "text"), ["accession", "section"])
        self.with_statuses(done.select("accession", F.col("full.status").alias("parse_status")))
        counts = done.agg(F.count_if(F.col("full.status") == "ok").alias("parsed"), F.count_if(F.col("full.status") != "ok").alias("failed"), F.count_if(F.size("full.suspicious_flags") > 0).alias("suspicious")).first().asDict()
        rows = [(r[0],) for r in done.select("accession").collect()] if limit is not None else []  # no more than the limit
        return counts, tried.unionByName(self.spark.createDataFrame(rows, "accession string"))

    def sections(self, stack: str = "sp500", ciks: list[int] | None = None, limit: int | None = None, force: bool = False) -> dict[str, int]:
        filings, records = self.store.read("filings"), self.store.read("records")
        todo = self.store.stage("to_extract", select.to_extract(filings, records, stack, force, ciks, limit))
        texts = self.store.read("texts").where("section = 'full'")
        there = self.chosen(stack).select("accession", F.lit(True).alias("raw"))
        rows = todo.select("accession", "form_type").join(texts, "accession", "left").join(there, "accession", "left")
        made = rows.select("accession", "raw", sections.split_sections(F.col("text"), F.col("form_type")).alias("s")).select("accession", "s.risk_factors", "s.mdna", F.when(F.col("raw").isNull(), "raw_missing").otherwise(F.col("s.error")).alias("error"))
        pieces = self.store.stage("pieces", made)
        new = self.store.stage("sections", diagnose.section_records(records.join(todo.select("accession"), "accession", "left_semi"), pieces))
        self.store.upsert("records", new, ["accession"])
        self.store.upsert("texts", diagnose.section_texts(new, pieces), ["accession", "section"])
        fresh = new.select("accession", F.col("status").alias("parse_status"))
        counts = {r[0]: r[1] for r in fresh.groupBy("parse_status").count().collect()}
        self.with_statuses(fresh)
        # only companies that have a new record can have other jumps
        companies = new.select("cik").distinct()
        near = self.store.read("records").join(companies, "cik", "left_semi")
        self.store.upsert("records", diagnose.flagged_records(near, self.store.read("filings").join(companies, "cik", "left_semi")), ["accession"])
        return {k: counts.get(k, 0) for k in ("ok", "partial", "section_fail")}

    def validation_sheet(self, n: int = 40, seed: int = 0) -> Path:
        """Write the filings to be labelled by hand as a CSV file with empty columns for the labels."""
        picked = diagnose.validation_set(self.store.read("records"), self.store.read("filings"), n, seed)
        rows = diagnose.validation_sheet(picked)
        out = io.StringIO()
        writer = csv.writer(out)
        writer.writerow(rows.columns)
        writer.writerows(rows.collect())  # n rows
        edgar.write_atomically(self.config.labels, out.getvalue().encode())
        return self.config.labels

    def validation(self) -> list[dict]:
        """Accuracy of the sections against the labels in that file."""
        if not self.config.labels.exists():
            raise FileNotFoundError(f"{self.config.labels} isn't there; write it with sections --pick-validation and label it")
        with self.config.labels.open(newline="", encoding="utf-8") as f:
            found = [(int(r["cik"]), r["accession"], *(r.get(c) or "" for c in diagnose.LABELS)) for r in csv.DictReader(f)]
        labels = self.spark.createDataFrame(found, "cik bigint, accession string, " + ", ".join(f"{c} string" for c in diagnose.LABELS))
        return [r.asDict() for r in diagnose.validation_accuracy(labels, self.store.read("texts")).orderBy("section").collect()]

    def lexicon(self) -> DataFrame:
        return lexicon.read_csv(self.spark, str(self.config.lexicon))

    def score(self, stack: str = "sp500", ciks: list[int] | None = None, limit: int | None = None, force: bool = False, df: DataFrame | None = None, n_docs: DataFrame | None = None) -> dict[str, int]:
        filings, old = self.store.read("filings"), self.store.read("scores")
        texts = self.store.read("texts").join(filings.where(F.col("stack") == of_stack(stack)).select("accession", "cik"), "accession")
        if df is None:
            df, n_docs = score.document_frequencies(texts, ciks, self.lexicon())
        todo = select.to_score(filings.where(F.col("stack") == of_stack(stack)), old, force, ciks, limit)
        usable = score.eligible_texts(texts.drop("cik"), self.store.read("records")).join(todo.select("accession"), "accession", "left_semi")
        rows = self.store.stage("scored", score.score_filings(usable, self.lexicon(), df, n_docs, now()))
        self.store.upsert("scores", rows)
        return rows.agg(F.countDistinct("accession").alias("processed"), F.count("*").alias("rows_written")).first().asDict()

    def refresh(self) -> dict[str, dict[str, int]]:
        """All stages, quarterly reports only; filing lists are fetched anew, or new filings would stay unseen."""
        job = Job(self.spark, self.config.quarterly().ensure(), self.fetch)
        out = {"membership": job.membership(), "download": job.download(refresh=True), "parse": job.parse(), "sections": job.sections(), "score": job.score()}
        edgar.write_atomically(self.config.stamp, (now() + "\n").encode())
        return out


def last_refresh(config: Config) -> str:
    return (config.stamp.read_text().strip() if config.stamp.exists() else "") or "Never"
