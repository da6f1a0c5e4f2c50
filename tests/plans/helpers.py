"""Run one dataset on made pages."""

from docketloom.plans import dataset, feeds, listings  # noqa: F401  (registers the datasets)

AS_OF, SCRAPED = "2026-09-30", "2026-09-30T00:00:00+00:00"


def run(spark, slug, **inputs):
    """Rows of a dataset as dicts; inputs that aren't given are empty."""
    spec = dataset.get(slug)
    frames = {name: spark.createDataFrame(inputs.get(name, []), schema) for name, schema in spec.inputs.items()}
    made = spec.rows(frames, SCRAPED, AS_OF)
    order = [dataset.F.desc(c[1:]) if c.startswith("-") else dataset.F.asc(c) for c in spec.order]
    table = dataset.to_wide(made.orderBy(*order), spec.columns)
    assert table.columns == list(spec.columns)
    return [r.asDict() for r in table.collect()]


def check(rows, *wanted):
    """Each row holds the wanted values, in order."""
    assert len(rows) == len(wanted), rows
    for row, want in zip(rows, wanted):
        assert {k: row[k] for k in want} == want
        assert all(v is not None for v in row.values())
