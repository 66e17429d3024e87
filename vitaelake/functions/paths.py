"""Keys taken from a landing path ``<root>/<category>/<resume_id>.<ext>``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def resume_id_of(path: Column, extension: str = "pdf") -> Column:
    """File stem; ``''`` where the path does not end in the extension."""
    return F.regexp_extract(path, rf"([^/]+)\.{re.escape(extension)}$", 1)


def category_of(path: Column, extension: str = "pdf") -> Column:
    """Name of the parent folder; ``''`` where there is none."""
    return F.regexp_extract(path, rf"/([^/]+)/[^/]+\.{re.escape(extension)}$", 1)
