"""boxoffice: a ticket-sales warehouse loader on PySpark DataFrames."""
