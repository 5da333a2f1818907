from cdcspark.streaming.metrics import StreamMetrics, observed, run_reported
from cdcspark.streaming.run import (
    DEFAULT_INTERVAL,
    MONITOR_INTERVAL,
    run_continuous,
    run_every,
    run_monitor,
    run_stream,
)
from cdcspark.streaming.transactions import TransactionError, run_transactions, transaction_ends, whole_upto
