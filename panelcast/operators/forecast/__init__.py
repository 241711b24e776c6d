"""Forecasters.  All give the keys, ``h``, ``ts``, ``yhat``, ``lower``, ``upper``, ``origin_ts``."""
