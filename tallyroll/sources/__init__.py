"""Reading loosely structured tables and paged records; writing tables and report sets."""
