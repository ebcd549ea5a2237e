"""DataFrame operators."""

from cascata.operators.counting import lines, range_tokens, rename, tokenize_text, tokens, word_count
from cascata.operators.keyed import key_value, latest_per_key
from cascata.operators.lineage import materialize
from cascata.operators.prefix import (bucket_boundaries, dense_boundaries, order_boundaries, running_totals, with_bucket,
                                      with_order_bucket)
from cascata.operators.requests import FunctionRegistry, default_registry, respond
from cascata.operators.routing import outcome_counts, receipts, split_outcomes, with_outcome
from cascata.operators.running import (running_count, running_sum, running_sum_with_outcome, snapshot_per_event,
                                       total_sum)
from cascata.operators.sequence import keyed_sequence, replicate, sequence_number
from cascata.operators.sharding import (key_task, merged_shard_total, replicated_running_sum,
                                        replicated_source_sharded_sum, shard_task, sharded_running_sum,
                                        shuffled_running_sum)

__all__ = [
    "FunctionRegistry", "bucket_boundaries", "default_registry", "dense_boundaries", "key_task", "key_value",
    "keyed_sequence", "latest_per_key", "lines", "materialize", "merged_shard_total", "order_boundaries", "outcome_counts", "range_tokens", "receipts",
    "rename", "replicate", "replicated_running_sum", "replicated_source_sharded_sum", "respond",
    "running_count", "running_sum", "running_sum_with_outcome", "running_totals", "sequence_number",
    "shard_task", "sharded_running_sum", "shuffled_running_sum", "snapshot_per_event", "split_outcomes", "tokenize_text",
    "tokens", "total_sum", "with_bucket", "with_order_bucket", "with_outcome", "word_count",
]
