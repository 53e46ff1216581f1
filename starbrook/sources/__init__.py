"""Where rows come from and go to: event feeds, range data, warehouse tables, JDBC."""
