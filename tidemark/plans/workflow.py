"""The whole run over one raw table: every table the reports are made of, by name."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tidemark import vocab
from tidemark.operators import confidence, findings, profile, rules
from tidemark.operators.audit import audit_summary
from tidemark.operators.cleaning import CleaningResult, clean
from tidemark.plans import reports
from tidemark.session import stored_table


ANALYSIS_COLUMNS = [
    "row_index", "category", "priority", "triaged", "contact_count", "assigned_agent", "duration_days", "intake_month", "intake_ordinal",
]


@dataclass
class Assessment:
    """Tables of a full run. Each plan is built when first asked for; ``closed`` is also computed, as all findings read it."""

    raw: DataFrame
    reference_date: str = vocab.REFERENCE_DATE
    plans_of: Assessment | None = None

    @cached_property
    def cleaning(self) -> CleaningResult:
        return self.plans_of.cleaning if self.plans_of else clean(self.raw, self.reference_date)

    @cached_property
    def hits(self) -> DataFrame:
        return self.plans_of.hits if self.plans_of else rules.rule_hits_by_row(self.raw, self.reference_date)

    def fresh(self) -> Assessment:
        """The same plans with no rows computed yet."""
        return Assessment(self.raw, self.reference_date, self)

    @property
    def quality(self) -> DataFrame:
        return rules.quality_score(self.hits)

    @cached_property
    def narrow(self) -> CleaningResult:
        """Model columns and disposition of every case, stored: cleaned once, asked often."""
        flagged = self.cleaning.flagged
        needed = [c for c in (*ANALYSIS_COLUMNS, "intake_date", "status", "disposition") if c in flagged.columns]
        return CleaningResult(stored_table(flagged.select(*needed)).table)

    @cached_property
    def closed(self) -> DataFrame:
        """Closed cases, model columns only, from the stored narrow table.

        The table is stored before the filter on status and duration: pushed down to the scan, that filter
        would evaluate the date parsers and the status rules a second time.
        """
        closed = findings.closed_cases(self.narrow.cleaned)
        return closed.select(*[c for c in ANALYSIS_COLUMNS if c in closed.columns])

    @cached_property
    def trend(self) -> DataFrame:
        return findings.trend_finding(self.closed)

    @cached_property
    def drivers(self) -> DataFrame:
        return findings.driver_finding(self.closed)

    @cached_property
    def triage(self) -> DataFrame:
        return findings.triage_finding(self.closed)

    @property
    def scorecard(self) -> DataFrame:
        facts = self.narrow.row_counts.select("initial_rows", "final_rows").withColumn(
            "quality_score", self.quality.select("quality_score").scalar()
        )
        facts = stored_table(facts).table  # one row that all three cards read
        return confidence.scorecard(
            self.trend, self.drivers, self.triage, findings.triage_crosstab(self.closed),
            facts.select("quality_score").scalar(),
            facts.select("initial_rows").scalar(),
            facts.select("final_rows").scalar(),
        )

    def stored(self) -> Assessment:
        """The same run with its raw rows, rule hits, cleaning and findings stored: many tables read them, none computes them again."""
        run = Assessment(stored_table(self.raw).table, self.reference_date)
        run.cleaning = CleaningResult(stored_table(run.cleaning.flagged).table)
        run.hits = stored_table(run.hits).table
        run.trend, run.drivers, run.triage = (stored_table(found).table for found in (run.trend, run.drivers, run.triage))
        return run

    def tables(self) -> dict[str, DataFrame]:
        """Every report table by name, for ``sources.bundle.publish``; a ``stored`` run is the one to ask."""
        return {
            "quality_score": self.quality,
            "anomaly_listing": rules.anomaly_listing(self.hits),
            "column_profile": profile.column_profile(self.raw),
            "cleaning_summary": self.cleaning.summary,
            "audit_summary": audit_summary(self.cleaning.audit()),
            "dataset_overview": reports.dataset_overview(self.cleaning, len(self.raw.columns) - 1),
            "lifecycle_funnel": reports.lifecycle_funnel(self.cleaning),
            "dispositions": reports.dispositions(self.cleaning),
            "censoring_by_month": reports.censoring_by_month(self.cleaning.cleaned),
            "monthly_trend": reports.monthly_trend(self.closed),
            "category_spread": reports.category_spread(self.closed),
            "triage_boxes": reports.triage_boxes(self.closed),
            "category_triage_means": reports.category_triage_means(self.closed),
            "category_mix_by_month": reports.category_mix_by_month(self.closed),
            "sparse_cells": reports.sparse_cells(self.closed),
            "trend_finding": self.trend,
            "driver_finding": self.drivers,
            "triage_finding": self.triage,
            "confidence_scorecard": self.scorecard,
        }


def assess(raw: DataFrame, reference_date: str = vocab.REFERENCE_DATE) -> Assessment:
    return Assessment(raw, reference_date)
