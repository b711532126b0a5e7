"""All registered queries. Importing a section registers it."""

from echofield.plans import section_a, section_b, section_d, section_e, section_fg, section_h, section_i, section_j, section_l, section_m, section_n  # noqa: F401
from echofield.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
