"""feedloom — a Spark-native job-feed analytics engine.

Feed documents, web pages and model responses are tables; every job is a
set-oriented DataFrame program that takes the current time as an explicit
argument.  Sub-packages:

* ``functions`` — scalar rules as native ``Column`` builders (no row UDFs)
* ``sources``   — readers, adapters and sinks (feeds, pages, payloads, files)
* ``operators`` — table jobs: ingest, dedupe, enrich, extract, lifecycle,
  publish, monitor
* ``plans``     — adapter views over the test tables and the query catalog
* ``streaming`` — Structured Streaming versions of the continuous jobs
"""

from feedloom.session import get_session, checkpoint_dir, ts_lit

__all__ = ["get_session", "checkpoint_dir", "ts_lit"]
