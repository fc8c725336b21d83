"""restframe: REST enrichment and HTTP delivery as plain Spark DataFrame work."""

from restframe.operators.lookup import lookup_join
from restframe.sources.delivery import deliver
from restframe.spec import LookupSpec, SinkSpec

__all__ = ["LookupSpec", "SinkSpec", "deliver", "lookup_join"]
