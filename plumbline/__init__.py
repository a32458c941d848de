"""plumbline: trust checks, feature preparation and scoring for labelled tables, as Spark jobs."""
