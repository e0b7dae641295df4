"""DataFrame operators of the forecasting and restock flow."""
