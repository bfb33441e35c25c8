"""Every operator as a query over the given tables, with an equivalent SQL text where there is one."""
