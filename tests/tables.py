"""Rows of small results, in an order that does not depend on the plan."""


def rows(df, *order):
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: [str(r[c]) for c in (order or df.columns)])
