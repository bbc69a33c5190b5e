"""Relational operators of the assessment: filters, joins, reports,
incremental marks, page chains and metric series."""
