"""DataFrame-to-DataFrame operators. No I/O and no clocks in here."""
