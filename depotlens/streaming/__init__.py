"""Incremental runs over arriving daily files (Structured Streaming).

The depot book itself is a daily batch: files arrive once a day and a day is
re-run to absorb late corrections. ``daily_files.feature_stream`` turns that
into a file-source stream with ``availableNow`` triggers, so each run picks up
exactly the files it has not processed yet.
"""
