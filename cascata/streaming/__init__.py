"""Structured Streaming jobs."""

from cascata.streaming.jobs import (BatchCommits, DeadLetterBook, OutcomeRouter, ResponseWriter, count_changes, decode_messages,
                                    message_router, range_router, replay_dead_letters, resolve_dead_letters, responses_for,
                                    start, unresolved_dead_letters, word_count_stream)
from cascata.streaming.ledger import FileLedger, start_ledgered_lines
from cascata.streaming.running import RunningTotalsWriter, ShuffledSumWriter, SnapshotWriter, start_running_totals

__all__ = ["BatchCommits", "DeadLetterBook", "FileLedger", "OutcomeRouter", "ResponseWriter", "RunningTotalsWriter",
           "ShuffledSumWriter", "SnapshotWriter", "start_ledgered_lines", "count_changes", "decode_messages",
           "message_router", "range_router", "replay_dead_letters", "resolve_dead_letters", "responses_for", "start",
           "start_running_totals", "unresolved_dead_letters", "word_count_stream"]
