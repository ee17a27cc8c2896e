"""Settings of the engine: the ingest rules and the filters of the dashboard."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

# Topic labels, version 1 of the vocabulary.
LABEL_VOCABULARY = (
    "Architektur",
    "Barrierefreiheit",
    "Beteiligung",
    "Betrieb",
    "Daten",
    "Datenschutz",
    "Datensicherheit",
    "EU",
    "Entwicklung",
    "Finanzierung",
    "Governance",
    "GovTech",
    "Identität",
    "Infrastruktur",
    "Integration",
    "Interoperabilität",
    "Kryptografie",
    "Künstliche Intelligenz",
    "Low Code",
    "Methodik",
    "Open Source",
    "Organisation",
    "Plattform",
    "Sicherheit",
    "Souveränität",
    "Standards",
    "Strategie",
    "Usability",
    "Toolvorschlag",
    "Zukunftsfähigkeit",
    "Ökosystem",
)

# Form titles, pages and descriptions with a meaning of their own.
FORM_PREFIX = "Feedback für die Seite"
NON_FORM_PAGE = "Via OpenCode"
BOILERPLATE = "**Feedback:** <br>"
UNCLEAR = "Unklar"
HOME_PAGE = "home"
EXCLUDED_IIDS = (1, 2, 3, 4, 5, 6, 7, 8)
EXCLUDED_DESCRIPTIONS = ("", "test", "Test")
EXCLUDED_PAGES = (
    "/beteiligung?utm_source=chatgpt.com",
    "/wtf",
    "/landkarte/ Tech-Stack Aufnahmekriterien & Prozess",
)

# Fixed value: where the very first incremental run starts.
FIRST_WATERMARK = datetime(2025, 12, 31, 23, 59, 59)

# The year whose issues belong to the second consultation round.
SECOND_ROUND_YEAR = 2026

# Columns that survive cleaning, in this order.
CLEAN_COLUMNS = (
    "iid",
    "title",
    "description",
    "state",
    "created_at",
    "updated_at",
    "closed_at",
    "author_id",
    "author_name",
    "author_state",
    "user_notes_count",
    "upvotes",
    "downvotes",
    "references",
)

# A small starter lexicon; projects bring their own word weights.
STARTER_LEXICON = {
    "gut": 1,
    "hilfreich": 1,
    "sinnvoll": 1,
    "begrüßen": 1,
    "danke": 1,
    "leider": -1,
    "fehlt": -1,
    "unklar": -1,
    "schlecht": -1,
    "problem": -1,
}


def rules_from_vocabulary(labels: Sequence[str]) -> tuple[tuple[str, str], ...]:
    """One rule per label: the label is given where its own words stand one after another."""
    phrases = ((label, " ".join(re.findall(r"[^\W\d_]+", label.lower()))) for label in labels)
    return tuple((label, phrase) for label, phrase in phrases if phrase)


@dataclass(frozen=True)
class IngestConfig:
    """Rules of one ingest run. Tests and projects override single fields."""

    label_version: int = 1
    vocabulary: tuple[str, ...] = LABEL_VOCABULARY
    excluded_iids: tuple[int, ...] = EXCLUDED_IIDS
    excluded_descriptions: tuple[str, ...] = EXCLUDED_DESCRIPTIONS
    excluded_pages: tuple[str, ...] = EXCLUDED_PAGES
    boilerplate: str = BOILERPLATE
    form_prefix: str = FORM_PREFIX
    non_form_page: str = NON_FORM_PAGE
    unclear: str = UNCLEAR
    home_page: str = HOME_PAGE
    second_round_year: int = SECOND_ROUND_YEAR
    clean_columns: tuple[str, ...] = CLEAN_COLUMNS
    lexicon: Mapping[str, int] = field(default_factory=lambda: dict(STARTER_LEXICON))
    label_rules: tuple[tuple[str, str], ...] = rules_from_vocabulary(LABEL_VOCABULARY)
    watermark_column: str = "created_at"

    @property
    def label_column(self) -> str:
        return f"labels_v{self.label_version}"


@dataclass(frozen=True)
class IssueFilter:
    """Dashboard filter state. Empty fields do not filter; the sentiment range always does."""

    labels: tuple[str, ...] = ()
    pages: tuple[str, ...] = ()
    sentiment: tuple[float, float] = (-1.0, 1.0)
    authors: tuple[str, ...] = ()
    orgs: tuple[str, ...] = ()
    rounds: tuple[int, ...] = ()
    search: str = ""
    search_literal: bool = False
    label_column: str = "labels_v1"
