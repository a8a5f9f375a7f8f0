"""DataFrame operators. Each is lazy and takes its column names as arguments."""
