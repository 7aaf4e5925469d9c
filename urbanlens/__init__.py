"""urbanlens: urban event analytics expressed as Spark DataFrame plans.

Four families of questions, each a lazy DataFrame the caller acts on once:

* share of events per part of day            -> ``operators.shares``
* top-k periods per group with explicit ties -> ``operators.ranking``
* weighted ratio per area over nested records -> ``operators.areas``
* nearest site per point, great-circle        -> ``operators.nearest``

Sources and sinks live in ``sources``, column expressions in ``functions``,
the query catalogue over the driver tables in ``plans``.
"""

from urbanlens.session import checkpoint_dir, get_session, scale_conf, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scale_conf", "scratch_path"]
