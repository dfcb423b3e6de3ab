"""Jobs put together from sources and operators, and the registered queries."""
