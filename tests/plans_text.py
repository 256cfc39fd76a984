"""Plans as text."""

import re


def plan_text(df, executed=False):
    """The plan as Spark would start it, or the adaptive plan after a run."""
    if executed:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0] if executed else text


def join_order(df):
    """Catalog tables of the optimized plan, the ones that are joined first in front."""
    found = []
    for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
        name = re.search(r"Relation [\w.]*?(\w+)\[", line)
        if name:
            found.append((len(line) - len(line.lstrip(" :+-")), name.group(1)))
    return [name for _, name in sorted(found, key=lambda pair: -pair[0])]


def estimated_rows(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().rowCount().get()))
