"""claimlake: a multi-tenant claims medallion engine on PySpark.

Every operator is a plain function from DataFrame(s) to DataFrame that
leaves physical planning to Catalyst and AQE.
"""

from claimlake.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
