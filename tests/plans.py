"""What a physical plan contains, as text."""

import contextlib
import io


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def count(df, node):
    return sum(line.strip().lstrip("+-: *()0123456789").startswith(node) for line in plan(df, "simple").splitlines())
