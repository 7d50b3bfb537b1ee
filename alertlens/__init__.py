"""alertlens: weekly alert-control analytics as Spark DataFrame plans.

Layout
------
functions/   Column -> Column helpers (parsing, calendar, flags, buckets)
sources/     envelope scans, the fixture adapter over ``events``, history reads
operators/   DataFrame -> DataFrame operators (dedup, as-of preference, joins, aggregates)
plans/       composite outputs: final table, scorecard, failure lists, weekly run
sinks/       writers (final, scorecard, failure lists, history with dynamic overwrite)
llm/         training-data operators; nothing else imports it

Every operator outside llm/ is lazy (no action inside) and uses built-in expressions only.
"""

from alertlens.options import PORT, RECORD, STRICT, Options

__all__ = ["Options", "RECORD", "PORT", "STRICT"]
