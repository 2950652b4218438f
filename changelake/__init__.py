"""changelake: change-log tables to validated star-schema tables on Spark.

Main entry points (imported lazily so ``import changelake`` stays cheap):

* ``changelake.operators.cdc.reconcile``      newest live row per key
* ``changelake.operators.quality.split``      valid rows / quarantined rows
* ``changelake.plans.silver_job.run_table``   one Silver table end to end
* ``changelake.plans.gold_job.run_gold``      marts + layer checks
* ``changelake.streaming.incremental``        incremental change apply
"""

__version__ = "0.1.0"

__all__ = ["reconcile", "split", "annotate", "run_table", "run_all", "run_gold", "SPECS"]


def __getattr__(name):
    if name == "reconcile":
        from .operators.cdc import reconcile
        return reconcile
    if name in ("split", "annotate"):
        from .operators import quality
        return getattr(quality, name)
    if name in ("run_table", "run_all"):
        from .plans import silver_job
        return getattr(silver_job, name)
    if name == "run_gold":
        from .plans.gold_job import run_gold
        return run_gold
    if name == "SPECS":
        from .plans.specs import SPECS
        return SPECS
    raise AttributeError(name)
