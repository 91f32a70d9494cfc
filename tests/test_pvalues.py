"""p-values against closed forms, from one degree of freedom to 1e12 and deep into the tails."""

import math

import pytest

from churnlab.functions import pvalues as PV


@pytest.mark.parametrize("x", [1e-9, 1e-3, 0.5, 1.0, 3.0, 20.0, 400.0, 1200.0])
def test_chi_squared(x):
    assert PV.chi2_sf(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
    assert PV.chi2_sf(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-10)
    assert PV.chi2_sf(x, 6) == pytest.approx(math.exp(-x / 2) * (1 + x / 2 + x * x / 8), rel=1e-10)


@pytest.mark.parametrize("t", [1e-6, 0.1, 1.0, 5.0, 40.0, 1e6])
def test_t_of_few_degrees(t):
    assert PV.t_two_sided(t, 1) == pytest.approx(2 / math.pi * math.atan(1 / t), rel=1e-10)
    assert PV.t_two_sided(-t, 2) == pytest.approx(2 / (math.sqrt(2 + t * t) * (math.sqrt(2 + t * t) + t)), rel=1e-10)


@pytest.mark.parametrize("df", [1e8, 1e10, 1e12])
def test_t_of_many_degrees_is_normal(df):
    for t in (0.3, 1.0, 4.0, 20.0):
        # the first term of the expansion in 1 / df
        first = math.erfc(t / math.sqrt(2)) + math.sqrt(2 / math.pi) * math.exp(-t * t / 2) * (t ** 3 + t) / (4 * df)
        assert PV.t_two_sided(t, df) == pytest.approx(first, rel=1e-6)
    assert PV.t_two_sided(1.0, 1e12) == pytest.approx(0.31731050786, abs=1e-10)


@pytest.mark.parametrize("d2", [1, 3, 10, 1e4, 1e9, 1e12])
def test_f(d2):
    for f in (1e-4, 0.5, 1.0, 3.0, 30.0):
        assert PV.f_sf(f, 2, d2) == pytest.approx(math.exp(-d2 / 2 * math.log1p(2 * f / d2)), rel=1e-8)
        assert PV.f_sf(f * f, 1, d2) == pytest.approx(PV.t_two_sided(f, d2), rel=1e-10)
    assert PV.f_sf(1.0, d2, d2) == pytest.approx(0.5, rel=1e-6)


@pytest.mark.parametrize("dof", [1e6, 1e9, 1e12])
def test_chi_squared_of_many_degrees(dof):
    # one standard deviation up: the skewness term vanishes there
    assert PV.chi2_sf(dof + math.sqrt(2 * dof), dof) == pytest.approx(math.erfc(math.sqrt(0.5)) / 2, rel=20 / dof + 1e-6)


def test_ends():
    assert PV.chi2_sf(0.0, 3) == PV.f_sf(0.0, 2, 3) == PV.t_two_sided(0.0, 5) == 1.0
    assert all(math.isnan(v) for v in (PV.chi2_sf(float("inf"), 1), PV.t_two_sided(1.0, 0), PV.f_sf(float("nan"), 1, 1), PV.chi2_sf(None, 1)))
    assert 0 < PV.chi2_sf(1400.0, 1) < 1e-300
