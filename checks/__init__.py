"""Every query by name, over the sample tables, with the SQL that has to agree."""

from . import expressions, relations, reports, sources

CHECKS = {**reports.CHECKS, **sources.CHECKS, **expressions.CHECKS, **relations.CHECKS}
