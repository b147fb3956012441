"""Whole flows: a dump tree to snapshots, a run tree to a corpus, a corpus to prompts, a batch to its report."""
