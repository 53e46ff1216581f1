"""Report queries and the views they are checked on."""
