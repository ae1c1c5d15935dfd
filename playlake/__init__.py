"""Playback-telemetry analytics on Spark.

Raw JSON events are landed with their source coordinates (Bronze), checked
against a versioned contract, split into a valid deduplicated fact (Silver)
and a quarantine with exact error codes, then rolled up into engagement and
quality-of-experience marts (Gold). Every rule, measure and mart is a
``Column`` or ``DataFrame -> DataFrame`` function shared by the batch run
(``playlake.plans.batch``) and the Structured Streaming jobs
(``playlake.streaming.jobs``).
"""

__version__ = "0.1.0"
