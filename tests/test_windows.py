"""A date window must act as if the windowed tables held only the rows inside it."""

import pytest

from carelint import Context, model
from carelint.functions import expr as E
from carelint.operators import CHECKS
from pyspark.sql import functions as F
from verify import fixtures as fx
from verify.catalog import comparable

START, END = "1998-03-01", "2000-02-29"
CHILDREN = {t for t, _ in model.PATIENT_CHILDREN}
# Which tables a check restricts; None means every table that has a window column.
RESTRICTED = {
    "1.05": None, "1.06": None, "1.07": None, "1.08": CHILDREN, "1.09": None, "1.10": set(), "1.11": None, "1.12": None,
    "1.13": set(), "1.16": None, "1.17": None, "1.18": set(), "1.20": None, "2.01": None, "2.02": None, "2.04": None,
    "2.07": {"ENCOUNTER"}, "2.09": None, "3.01": {"ENCOUNTER"}, "3.02": {"ENCOUNTER"}, "3.03": None, "3.04": None, "3.05": None,
    "3.06": {"ENCOUNTER"}, "3.08": None, "3.09": None, "3.10": None, "3.12": None, "3.15": None, "3.16": None, "3.17": None,
}


def rows(df):
    return sorted(map(str, comparable(df).collect()))


@pytest.mark.parametrize("number", list(RESTRICTED))
def test_window(spark, sf, number):
    ctx = fx.context(spark, sf)
    tables = set(model.DATE_COLUMN) if RESTRICTED[number] is None else RESTRICTED[number] & set(model.DATE_COLUMN)

    def inside(table):
        df = ctx.source.frame(table)
        day = E.date_of(df, model.DATE_COLUMN[table])
        return df.filter(day.between(F.lit(START).cast("date"), F.lit(END).cast("date")))

    cut = ctx.source.with_frames({t: (lambda t=t: inside(t)) for t in tables if ctx.source.has(t)})
    windowed = Context(ctx.source, ctx.refs, start=START, end=END, anchor=fx.ANCHOR)
    assert rows(CHECKS[number](windowed)) == rows(CHECKS[number](Context(cut, ctx.refs, anchor=fx.ANCHOR)))
