"""DataFrame-to-DataFrame operators on grouped time-series panels."""
