"""Plan-level helpers: plan text for inspection, reliable checkpoints."""

from socialpages.plans.inspect import count_nodes, plan_text
from socialpages.plans.lineage import discard, discard_leftovers, ensure_checkpoint_dir, materialize, scratch_path, staged
from socialpages.plans.ordering import numbered, with_offsets

__all__ = ["count_nodes", "discard", "discard_leftovers", "ensure_checkpoint_dir", "materialize", "numbered", "plan_text", "scratch_path", "staged", "with_offsets"]
