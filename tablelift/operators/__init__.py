"""DataFrame-to-DataFrame operators for migrating and reconciling tables."""
