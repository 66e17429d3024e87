"""Fixed values and their parameter objects."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    """Terms that raise a score and terms that lower it."""

    plus: tuple[str, ...]
    minus: tuple[str, ...]


# The answers depend on these exact lists and patterns.
LEADERSHIP = Lexicon(
    plus=("led", "managed", "architected", "founded"),
    minus=("assisted", "supported", "helped"),
)
SENIORITY = Lexicon(
    plus=("senior", "director", "vp", "chief", "principal", "head of", "executive"),
    minus=("junior", "intern", "entry level", "entry-level", "trainee"),
)
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
CATEGORY_PATTERN = r"[A-Za-z\-]+"
QUARANTINE_REASON = "empty_or_null_extracted_text"

# A search only asks whether a pattern occurs. One character of the local part
# is then as good as a run of them, which makes a long token without "@" cost
# linear instead of quadratic time, and an optional first character says nothing.
EMAIL_SEARCH_PATTERN = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_SEARCH_PATTERN = r"\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"

TOP_N_PER_CATEGORY = 10
LENGTH_BUCKETS = ("short", "medium", "long")

SEARCH_LIMIT_DEFAULT, SEARCH_LIMIT_MAX = 20, 100
MATCH_LIMIT_DEFAULT, MATCH_LIMIT_MAX = 10, 50
SHORTLIST_LIMIT_DEFAULT = 100
SNIPPET_CHARS = 200

# Shortlist column widths, in characters.
SHORTLIST_WIDTHS = {
    "recruiter_email": 255,
    "resume_id": 50,
    "category": 100,
    "job_title": 255,
}
SHORTLIST_KEY = ("recruiter_email", "resume_id", "job_title")
