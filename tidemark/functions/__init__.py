"""Column-level building blocks: calendar mapping, predicates, reshaping."""
