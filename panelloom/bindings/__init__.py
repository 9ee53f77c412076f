"""The operators bound to the driver's tables, each with its SQL counterpart."""

from panelloom.bindings import features, jobs, modelling, panels, selection, tables, texts

QUERIES = {**panels.QUERIES, **features.QUERIES, **selection.QUERIES, **modelling.QUERIES, **texts.QUERIES, **tables.QUERIES, **jobs.QUERIES}
ORACLES = {**panels.ORACLES, **features.ORACLES, **selection.ORACLES, **modelling.ORACLES, **texts.ORACLES, **tables.ORACLES, **jobs.ORACLES}
