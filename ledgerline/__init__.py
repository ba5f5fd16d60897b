"""ledgerline: order-to-cash change-data analytics as Spark DataFrame plans.

Layers:

* ``sources``   – readers for source tables, the change log, bronze event tables and the
                  TESTDATA fixture derivations.
* ``functions`` – ``Column -> Column`` decoders for the ERP character formats.
* ``operators`` – ``DataFrame -> DataFrame`` building blocks: CDC netting, current state,
                  SCD2, data-quality checks, table diffs.
* ``plans``     – the silver and gold models and the work-list queries, composed from the above.
* ``streaming`` – the same extraction as Structured Streaming micro-batches.
"""

from ledgerline.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
