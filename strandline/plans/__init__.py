"""End-to-end query plans over the fixture views, one per operator, with SQL oracles."""

from strandline.plans.registry import ORACLES, QUERIES, load_all  # noqa: F401
