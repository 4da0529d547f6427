from entries import city, graphs, joins, scalars, shapes, stores  # noqa: F401
from entries.registry import ORACLES, QUERIES  # noqa: F401
