"""ticketlens: customer analytics for ticketing data, as plain Spark DataFrame functions."""
