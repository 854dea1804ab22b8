"""The jobs on an order-management star schema: roles, registered queries, SQL oracles."""
