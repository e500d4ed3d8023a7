"""A session, a reference connection and comparisons for the queries of lodegate.llm."""

from __future__ import annotations

from lodegate.llm.queries import ORACLES, QUERIES
from tests.compare import normalized, reference


def differences(spark, folder: str, name: str) -> str:
    """'' where the query equals its reference SQL, else a few rows that differ."""
    frame = QUERIES[name](spark, folder)
    mine = normalized(frame.columns, frame.collect())
    cursor = reference(folder).execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    theirs = normalized(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if mine == theirs:
        return ""
    extra, missing = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
    return f"{len(mine)} and {len(theirs)} rows; {extra[:2]} instead of {missing[:2]}"
