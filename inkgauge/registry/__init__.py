"""All named queries. Importing this package registers them."""

from inkgauge.registry import learning, reports, streams, texts, vectors  # noqa: F401
from inkgauge.registry.base import ORACLES, QUERIES  # noqa: F401
