"""Where jobs and workers come from: tables, array parameters, payload codecs, and views derived from an event table."""
