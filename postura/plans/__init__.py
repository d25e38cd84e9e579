"""Report plans: shared blocks (``blocks``) and the reports grouped by subject."""
