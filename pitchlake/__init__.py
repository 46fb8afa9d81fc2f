"""pitchlake: Spark-native play-by-play ingestion, upsert, payload views,
run ledger and audit queries.

The main entry points, importable from the package root:

* ``flatten_games`` - live-feed documents -> event, pitch and play tables
* ``merge_frames`` / ``upsert_table`` - partial-column upsert by key
* ``pack_json`` / ``unpack`` / ``statcast_view`` / ``materialize`` - payload view
* ``ingest`` - ledger-driven loads (``ingest.run``, ``daily``, ``retry`` ...)
* ``ledger`` - chunks, plan, latest state, week gaps, stale runs
* ``diagnostics`` - the audit query set on the stored tables
* ``audit`` / ``windows`` - the generic operators behind them
"""

__version__ = "0.1.0"

from pitchlake.functions.payload import pack_json, unpack  # noqa: E402
from pitchlake.operators import audit, windows  # noqa: E402
from pitchlake.operators.merge import merge_frames, upsert_table  # noqa: E402
from pitchlake.operators.nested import flatten_games  # noqa: E402
from pitchlake.operators.views import materialize, statcast_view  # noqa: E402
from pitchlake.plans import diagnostics, ingest, ledger  # noqa: E402

__all__ = [
    "audit", "diagnostics", "flatten_games", "ingest", "ledger", "materialize", "merge_frames",
    "pack_json", "statcast_view", "unpack", "upsert_table", "windows",
]
