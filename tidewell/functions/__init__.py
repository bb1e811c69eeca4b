"""Column-level building blocks (all JVM-side built-in expressions)."""
from tidewell.functions.hashing import hash_uniform, hash_normal, hash_poisson1
from tidewell.functions.timecols import floor_days, month_index, as_ts
from tidewell.functions.ratios import cpa, roas, ltv_cac
from tidewell.functions.hill import hill

__all__ = ["hash_uniform", "hash_normal", "hash_poisson1", "floor_days", "month_index",
           "as_ts", "cpa", "roas", "ltv_cac", "hill"]
