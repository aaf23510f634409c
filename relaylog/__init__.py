"""Event-log delivery as Spark jobs: contract, change log, decode, route, outcomes, activity."""
