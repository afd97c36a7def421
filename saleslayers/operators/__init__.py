"""Row-set operators: validate, dedupe, merge, history, evolution."""
